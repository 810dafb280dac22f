"""Column expressions over a JSON request body held as a VARIANT.

Rules follow a Python JSON handler: a field is "missing" when it is absent, and a
present value counts as empty when it is falsy (null, "", 0, false, [], {}).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Response texts, status codes and the horizon bounds.
MSG_INVALID_BODY = "Invalid request body"
MSG_STORE_REQUIRED = "store_id is required"
MSG_ITEM_REQUIRED = "item_id is required"
MSG_BAD_DATE = "date must be in YYYY-MM-DD format"
MSG_BAD_HORIZON = "horizon must be an integer between 1 and 30"
MSG_INFERENCE_FAILED = "Inference failed: "
MSG_NULL_BODY = "the JSON object must be str, bytes or bytearray, not NoneType"
STATUS_OK, STATUS_BAD_REQUEST, STATUS_FAILED = 200, 400, 500
HORIZON_MIN, HORIZON_MAX, HORIZON_DEFAULT = 1, 30, 1
MSG_DATE_OVERFLOW = "date value out of range"
MAX_DATE = "9999-12-31"

INTEGER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def variant_type(v: Column) -> Column:
    """Top-level type name of a variant: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID..."""
    return F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1)


def python_type_name(v: Column) -> Column:
    """The name a Python JSON loader gives the value's type (for error texts)."""
    t = variant_type(v)
    return (
        F.when(t == "ARRAY", "list").when(t == "OBJECT", "dict").when(t == "STRING", "str")
        .when(t == "BOOLEAN", "bool").when(t == "VOID", "NoneType").when(t.isin(*INTEGER_TYPES), "int")
        .otherwise("float")
    )


def field(v: Column, name: str) -> Column:
    """Sub-variant of a top-level field; null when absent."""
    return F.try_variant_get(v, f"$.{name}", "variant")


# JSON texts of the falsy non-numeric values.
FALSY_JSON = ("null", '""', "false", "[]", "{}")


def is_truthy(x: Column, t: Column) -> Column:
    """Python truthiness of a JSON value ``x`` whose type name is ``t``; absent (null) is falsy."""
    numeric = t.isin(*INTEGER_TYPES, "DECIMAL", "DOUBLE", "FLOAT")
    return (
        F.when(x.isNull(), False)
        .when(numeric, F.try_variant_get(x, "$", "double") != 0)
        .otherwise(~F.to_json(x).isin(*FALSY_JSON))
    )


def as_text(x: Column, t: Column) -> Column:
    """A field echoed back as text: strings as they are, other JSON values as JSON text."""
    return F.when(t == "STRING", F.try_variant_get(x, "$", "string")).otherwise(F.to_json(x))


def horizon_value(h: Column, t: Column) -> Column:
    """Horizon as an integer, or null when it is not an accepted integer.

    Absent -> default 1; a JSON integer -> itself; ``true`` -> 1 (a bool is an int in
    Python); strings, decimals such as ``3.0``, doubles and null -> null (invalid).
    """
    return (
        F.when(h.isNull(), F.lit(HORIZON_DEFAULT).cast("bigint"))
        .when(t.isin(*INTEGER_TYPES), F.try_variant_get(h, "$", "bigint"))
        .when(t == "BOOLEAN", F.try_variant_get(h, "$", "boolean").cast("bigint"))
    )


def ascii_json(text: Column) -> Column:
    """JSON text with every character beyond ASCII as ``\\uXXXX`` (two of them beyond the basic plane)."""
    unit = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))

    def escaped(c: Column) -> Column:
        n = F.ascii(c)  # the code point
        low, high = F.lit(0xDC00) + (n - 0x10000) % 0x400, F.lit(0xD800) + F.shiftright(n - 0x10000, 10)
        return F.when(n < 0x80, c).when(n < 0x10000, unit(n)).otherwise(F.concat(unit(high), unit(low)))

    return F.when(F.octet_length(text) > F.char_length(text), F.array_join(F.transform(F.split(text, ""), escaped), "")).otherwise(text)


def spaced_json(compact: Column) -> Column:
    """JSON text with a blank after each comma and colon outside of strings; only arrays and objects have any."""
    spaced = F.regexp_replace(compact, r'\G((?:[^",:]++|"(?:[^"\\]++|\\.)*+")*+)([,:])', "$1$2 ")
    return F.when(F.substring(compact, 1, 1).isin("[", "{"), spaced).otherwise(compact)


def error_body(error: Column) -> Column:
    """``{"error": ...}`` as Python's ``json.dumps`` writes it."""
    return ascii_json(F.concat(F.lit('{"error": '), F.substring(F.to_json(F.struct(error.alias("error"))), 10, 2**31 - 1)))


def predictions_body(store_json: Column, item_json: Column, predictions: Column) -> Column:
    """The body of a scored request as Python's ``json.dumps`` writes it, NaN and infinities by their names."""
    days = F.transform(predictions, lambda p: F.concat(F.lit('{"date": "'), p["date"], F.lit('", "forecast": '), p["forecast"].cast("string"), F.lit("}")))
    return F.concat(F.lit('{"store_id": '), ascii_json(spaced_json(store_json)), F.lit(', "item_id": '), ascii_json(spaced_json(item_json)),
                    F.lit(', "predictions": ['), F.array_join(days, ", "), F.lit("]}"))
