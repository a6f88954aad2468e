"""Read fields of JSON text and say why one cannot be used."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that count as numbers. Digits may be grouped by single underscores.
_DIGITS = r"\d+(_\d+)*"
FLOAT_TEXT = rf"^[+-]?(({_DIGITS})(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
INT_TEXT = rf"^[+-]?{_DIGITS}$"
NON_FINITE_TEXT = r"^[+-]?(nan|inf|infinity)$"
_BLANKS = r"^\s+|\s+$"


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions refer to by value.

    Plain columns are merged into every filter and projection that uses them, so a parse that twenty
    expressions look at would run twenty times. A generated row is computed once and stays put.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def parse_json(df: DataFrame, raw: str, name: str) -> DataFrame:
    """Add the one JSON value that makes up the text, as VARIANT; NULL if there is none or more follows.

    The parser stops at the end of the first value. The text is put into a list before a hash of
    itself: it is one value if the list has these two entries and no others, whatever the text holds.
    Of repeated keys of an object the last counts, whatever the session was set to.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    seal = F.xxhash64(raw)
    text = F.concat(F.lit("["), F.col(raw), F.lit(","), seal.cast("string"), F.lit("]"))
    parsed = compute_once(df, _wrapped=F.try_parse_json(text), _seal=seal)
    whole = (F.try_variant_get("_wrapped", "$[1]", "bigint") == F.col("_seal")) & F.try_variant_get(
        "_wrapped", "$[2]", "variant"
    ).isNull()
    made = compute_once(parsed, **{name: F.when(whole, F.try_variant_get("_wrapped", "$[0]", "variant"))})
    return made.drop("_wrapped", "_seal")


def kind_of(v: Column) -> Column:
    """``STRING``, ``BIGINT``, ``OBJECT<..>``, ``VOID`` …; NULL when there is no value."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(kind_of(v).startswith("OBJECT"), F.lit(False))


def field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def with_fields(df: DataFrame, doc: Column, names: Sequence[str]) -> DataFrame:
    """Add each field of the document as ``_<name>`` and its kind as ``_<name>_kind``."""
    found = compute_once(df, **{f"_{c}": field(doc, c) for c in names})
    return compute_once(found, **{f"_{c}_kind": kind_of(F.col(f"_{c}")) for c in names})


@dataclass(frozen=True)
class Field:
    """A field added by ``with_fields``, and what it is called in reasons."""

    key: str
    name: str

    @property
    def variant(self) -> Column:
        return F.col(f"_{self.key}")

    @property
    def kind(self) -> Column:
        return F.col(f"_{self.key}_kind")

    @property
    def is_missing(self) -> Column:
        return self.variant.isNull()

    @property
    def is_null(self) -> Column:
        return self.kind == "VOID"

    def text(self) -> Column:
        """The value of a JSON string; NULL for any other kind."""
        return F.when(self.kind == "STRING", F.try_variant_get(self.variant, "$", "string"))

    def float(self) -> Column:
        """A JSON number, boolean or number text as DOUBLE, perhaps not finite; NULL for the rest."""
        text = F.regexp_replace(F.try_variant_get(self.variant, "$", "string"), _BLANKS, "")
        named = F.lower(text).rlike(NON_FINITE_TEXT)
        plain = F.when(text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        from_text = F.when(named, F.lit(float("nan"))).otherwise(plain)
        return F.when(self.kind == "STRING", from_text).otherwise(F.try_variant_get(self.variant, "$", "double"))

    def int(self) -> Column:
        """A JSON number cut to an integer, a boolean or an integer text; NULL for the rest."""
        text = F.regexp_replace(F.try_variant_get(self.variant, "$", "string"), _BLANKS, "")
        plain = F.when(text.rlike(INT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))
        return F.when(self.kind == "STRING", plain).otherwise(F.try_variant_get(self.variant, "$", "bigint"))

    def presence(self) -> Column:
        """``missing_<name>`` or ``null_<name>``; NULL when there is a value."""
        return F.when(self.is_missing, F.lit(f"missing_{self.name}")).when(self.is_null, F.lit(f"null_{self.name}"))

    def fault(self, value: Column) -> Column:
        """Why a present field gave this converted value; NULL if it can be used."""
        bad = F.lit(f"bad_{self.name}")
        # a number too large for an integer still converts to a double
        beyond = (self.kind != "STRING") & is_non_finite(F.try_variant_get(self.variant, "$", "double"))
        return F.when(value.isNull(), F.when(beyond, F.lit("non_finite")).otherwise(bad))

    def float_fault(self, value: Column) -> Column:
        return F.when(value.isNull(), F.lit(f"bad_{self.name}")).when(is_non_finite(value), F.lit("non_finite"))

    def text_fault(self, value: Column) -> Column:
        return F.when(value.isNull(), F.lit(f"bad_{self.name}"))


def is_non_finite(x: Column) -> Column:
    return F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(False))
