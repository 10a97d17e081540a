"""Safe parsers for values of unreliable type.

Every function takes a VARIANT column, so that the JSON type of the value (number or
text, null or absent) is still known. Whatever cannot be read becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.schemas import INT32_MAX, INT32_MIN

INT64_MAX, INT64_MIN = (1 << 63) - 1, -(1 << 63)

# Characters stripped from both ends of a text, and the accepted
# spellings of the two truth values.
BLANK_CODES = (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196,
    8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288,
)
BLANKS = "".join(map(chr, BLANK_CODES))
TRUE_TEXTS = ("true", "t", "1", "yes", "y")
FALSE_TEXTS = ("false", "f", "0", "no", "n")
# JSON texts of the values that do not count as given.
FALSY_JSON = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")


def parse_document(text: Column) -> Column:
    """JSON text to VARIANT, NULL when the text is not JSON."""
    return F.try_parse_json(text)


def get(value: Column, path: str, dtype: str = "variant") -> Column:
    """Nested path access that yields NULL wherever the path or the type does not fit."""
    return F.try_variant_get(value, path, dtype)


def get_struct(value: Column, path: str, names) -> Column:
    """Several fields of one object at once, each still a VARIANT; NULL for a non-object.

    Much cheaper than one path lookup per field.
    """
    return get(value, path, struct_type(names))


def struct_type(names) -> str:
    return "struct<" + ", ".join(f"`{n}`: variant" for n in dict.fromkeys(names)) + ">"


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not once for each place that names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def get_or(value: Column, path: str, default: Column, dtype: str = "string") -> Column:
    """Like ``get``, with a default for an absent path; a present JSON null stays NULL."""
    found = get(value, path)
    return F.when(found.isNull(), default).otherwise(get(found, "$", dtype))


def is_object(value: Column, path: str = "$") -> Column:
    return get_struct(value, path, ("_",)).isNotNull()


def is_filled_object(value: Column, path: str = "$") -> Column:
    return F.coalesce(F.size(get(value, path, "map<string,variant>")), F.lit(0)) > 0


def elements(value: Column) -> Column:
    """The elements of a JSON list as ARRAY<VARIANT>, NULL when it is no list."""
    return get(value, "$", "array<variant>")


def kind(value: Column) -> Column:
    """Type name of a scalar VARIANT; NULL when absent, VOID for a JSON null."""
    return F.schema_of_variant(value)


def _is_number(kind_name: Column) -> Column:
    return kind_name.isin("BIGINT", "DOUBLE", "FLOAT") | kind_name.startswith("DECIMAL")


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def to_long(value: Column) -> Column:
    """Integer value: numbers cut toward zero, texts only if they spell an integer.

    A value past 64 bits is the nearest 64-bit integer, which fits no 32-bit column either.
    Only values that are given and no 64-bit integer are looked at twice. Texts without a digit
    are told before they are cast: a cast that fails costs as much as ten that do not.
    """
    size = to_double(value)
    text = get(value, "$", "string")
    wordy = ~text.rlike("[0-9]") & (kind(value) == "STRING")
    spelled = text.rlike(r"^\s*[+-]?[0-9]+\s*$") | (kind(value) != "STRING")
    past = F.when(size > 0, F.lit(INT64_MAX)).otherwise(F.lit(INT64_MIN))
    # How it is spelled is looked at for large ones only.
    past = F.when(F.abs(size) > INT32_MAX, F.when(spelled, past))
    return F.when(wordy, F.lit(None)).otherwise(
        F.coalesce(get(value, "$", "bigint"), F.when(value.isNotNull(), past))
    )


def to_double(value: Column) -> Column:
    return get(value, "$", "double")


def to_bool(value: Column) -> Column:
    name = kind(value)
    word = F.lower(strip(get(value, "$", "string")))
    return (
        F.when(name == "BOOLEAN", get(value, "$", "boolean"))
        .when(_is_number(name), to_double(value) != 0)
        .when((name == "STRING") & word.isin(*TRUE_TEXTS), F.lit(True))
        .when((name == "STRING") & word.isin(*FALSE_TEXTS), F.lit(False))
    )


def to_text(value: Column) -> Column:
    """Text form with capitalised truth values and a decimal point kept on whole floats."""
    name = kind(value)
    text = get(value, "$", "string")
    whole_float = name.rlike(r"^DECIMAL\((\d|1[0-8]),0\)$")
    return F.when(name == "BOOLEAN", F.initcap(text)).when(whole_float, F.concat(text, F.lit(".0"))).otherwise(text)


def to_clean_text(value: Column) -> Column:
    """``to_text`` without surrounding blanks, NULL when nothing is left."""
    return F.nullif(strip(to_text(value)), F.lit(""))


def truthy(value: Column) -> Column:
    """False for absent, null, false, zero, empty text, empty list and empty object."""
    return F.coalesce(~F.to_json(value).isin(*FALSY_JSON), F.lit(False))


def first_truthy(*values: Column) -> Column:
    """The first truthy operand, else the last operand as it is."""
    *head, last = values
    picked = last
    for value in reversed(head):
        picked = F.when(truthy(value), value).otherwise(picked)
    return picked


def first_present(*values: Column) -> Column:
    """The repaired alias choice: a zero counts as a value, only null falls through."""
    *head, last = values
    picked = last
    for value in reversed(head):
        picked = F.when(F.to_json(value) != "null", value).otherwise(picked)
    return picked


def any_of(fields: Column, names: tuple[str, ...], zero_as_missing: bool = True) -> Column:
    """One field of a struct of VARIANTs under several spellings."""
    operands = [fields.getField(name) for name in names]
    return first_truthy(*operands) if zero_as_missing else first_present(*operands)


def int_from_text(text: Column) -> Column:
    """Integer parser for a plain STRING column."""
    return text.try_cast("bigint")


def double_from_text(text: Column) -> Column:
    return text.try_cast("double")


def outside_int32(*values: Column) -> Column:
    """True when any value does not fit a 32-bit column; nulls fit."""
    if len(values) == 1:
        return F.coalesce(~values[0].between(INT32_MIN, INT32_MAX), F.lit(False))
    return F.coalesce((F.least(*values) < INT32_MIN) | (F.greatest(*values) > INT32_MAX), F.lit(False))
