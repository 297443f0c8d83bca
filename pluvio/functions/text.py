"""Text columns: names, ids, key=value lists, lenient and strict numbers, fixed decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE_NAME = r"^DRain_(\d{4})-(\d{4})_RainNos_(.+)_([^_]+)$"


def page_name_parts(stem: Column) -> dict[str, Column]:
    """Years, descriptor and section of a page file's name; all null where it does not match."""
    part = lambda i: F.when(stem.rlike(PAGE_NAME), F.regexp_extract(stem, PAGE_NAME, i))
    return {"year_start": part(1).cast("int"), "year_end": part(2).cast("int"), "descriptor": part(3), "section_id": part(4)}


def without_suffix(name: Column, suffix: str = r"\.json$") -> Column:
    return F.regexp_replace(name, suffix, "")


def safe_id(name: Column) -> Column:
    """Letters, digits and ``._-`` of any script stay, all else becomes ``_``; nothing left: ``station``."""
    kept = F.regexp_replace(F.coalesce(name, F.lit("")), r"[^\p{L}\p{N}._-]", "_")
    return F.when(F.length(kept) == 0, F.lit("station")).otherwise(kept)


def meta_value(meta: Column, key: str, default: str = "NA") -> Column:
    """The value of a key in ``a=1|b=2``."""
    return F.coalesce(F.element_at(F.str_to_map(F.coalesce(meta, F.lit("")), F.lit(r"\|"), F.lit("=")), key), F.lit(default))


def lenient_double(text: Column) -> Column:
    """Null for blank, NA and whatever is no number."""
    t = F.trim(text)
    return F.when((t != "") & (F.upper(t) != "NA"), t.try_cast("double"))


def is_blank(text: Column) -> Column:
    """What a station table leaves out: nothing, nan, na, n/a."""
    return F.coalesce(F.lower(F.trim(text)).isin("", "nan", "na", "n/a"), F.lit(True))


def finite_or_zero(x: Column) -> Column:
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def is_missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def cents(x: Column) -> Column:
    """Hundredths as a whole number, rounded half to even in single precision."""
    return F.rint(x.cast("float") * F.lit(100.0).cast("float")).cast("int")


def decimals(x: Column, places: int, missing: str = "NA") -> Column:
    """Fixed decimals, half to even, without thousands marks; missing numbers as given."""
    return F.when(is_missing(x), F.lit(missing)).otherwise(F.call_function("format_number", x, F.lit("0." + "0" * places)))


def flag_or(text: Column, known: tuple[str, ...], other: str = "other") -> Column:
    t = F.lower(F.trim(text))
    return F.when(t.isin(*known), t).otherwise(F.lit(other))


def json_number(x: Column) -> Column:
    """A double as JSON text: decimals from 1e-4 up to 1e16, beyond that an exponent of two digits or more (``1e-05``); null, NaN and Infinity by those names.

    The digits are the JVM's. Before Java 19 these are not always the fewest, mostly for very large and very small numbers; the text reads back as the same double all the same."""
    plain = F.abs(x).cast("string")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(plain, "E", 1), r"\.", ""), "0+$", "")
    power = F.substring_index(plain, "E", -1).try_cast("int")
    whole = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0"))
    rest = F.substring(digits, power + 2, F.length(digits))
    large = F.concat(whole, F.lit("."), F.when(rest == "", "0").otherwise(rest))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    tail = F.substring(digits, F.lit(2), F.length(digits))
    size = F.abs(power).cast("string")
    other = F.concat(F.substring(digits, 1, 1), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)), F.when(power < 0, "e-").otherwise("e+"), F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size))
    shifted = F.when(power.between(0, 15), large).when(power.between(-4, -1), small).otherwise(other)
    sign = F.when(F.startswith(x.cast("string"), F.lit("-")), "-").otherwise("")
    return F.when(x.isNull(), "null").when(plain.contains("E"), F.concat(sign, shifted)).otherwise(F.concat(sign, plain))


def json_list(values: Column) -> Column:
    """An array of doubles as JSON text, a blank after each comma. Null stays null."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, json_number), ", "), F.lit("]"))


def json_object(**members: Column) -> Column:
    """JSON text of members in the order of their names. Each is JSON text itself; one that is null is left out."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *(F.concat(F.lit(f'"{k}": '), v) for k, v in sorted(members.items()))), F.lit("}"))
