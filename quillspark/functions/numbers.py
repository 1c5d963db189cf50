"""Tolerant numbers, and comparison of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# Decimal digits of the scripts that Indian paperwork uses besides ASCII.
INDIC = "".join(chr(base + d) for base in (0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0B66, 0x0BE6, 0x0C66, 0x0CE6, 0x0D66) for d in range(10))
ASCII_FOR_INDIC = "0123456789" * (len(INDIC) // 10)


def number_from_text(text: Column) -> Column:
    """The number in a text: everything but digits, points and minus signs is dropped, then what is left must be a number.

    A currency prefix with a point leaves that point: `Rs. 200` is 0.2. Null where nothing is left.
    """
    bare = F.regexp_replace(F.translate(text, INDIC, ASCII_FOR_INDIC), "[^0-9.\\-]", "")
    return let(bare, lambda b: F.when(b.rlike("^-?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)$"), b.try_cast("double")))


def number_from_variant(value: Column) -> Column:
    """The number in a variant: null for null and booleans, numbers as they are, else that of its text."""

    def one(x: Column) -> Column:
        v, kind = x["v"], x["kind"]
        return (
            F.when(v.isNull() | kind.isin("VOID", "BOOLEAN"), F.lit(None).cast("double"))
            .when(kind == "STRING", number_from_text(F.try_variant_get(v, "$", "string")))
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), number_from_text(F.to_json(v)))
            .otherwise(F.try_variant_get(v, "$", "double"))
        )

    return let(value, lambda v: let(F.struct(v.alias("v"), F.schema_of_variant(v).alias("kind")), one))


def numbers_match(have: Column, want: Column, relative: float = 0.005) -> Column:
    """Whether have is want within a share of it or a hundredth; false where either is null."""
    near = F.abs(have - want) <= F.greatest(F.abs(want) * relative, F.lit(0.01))
    return F.coalesce(F.when(want == 0, F.abs(have) < 1e-9).otherwise(near), F.lit(False))


def shown(x: Column) -> Column:
    """A double in shortest decimal notation with a point, without an exponent for ordinary sizes."""

    def one(v: Column) -> Column:
        whole = F.concat(v.cast("decimal(20,0)").cast("string"), F.lit(".0"))
        wide = F.regexp_replace(v.cast("decimal(38,9)").cast("string"), "0+$", "")
        return F.when((v == F.floor(v)) & (F.abs(v) < 1e16), whole).when((F.abs(v) >= 1e7) & (F.abs(v) < 1e16), wide).otherwise(v.cast("string"))

    return let(x, one)


def quoted(text: Column) -> Column:
    """Text in single quotes, or double ones where it holds only single ones."""
    inner = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    double = text.contains("'") & ~text.contains('"')
    single = F.replace(inner, F.lit("'"), F.lit("\\'"))
    return F.when(double, F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(F.concat(F.lit("'"), single, F.lit("'")))
