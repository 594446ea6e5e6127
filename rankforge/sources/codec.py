"""Row encoding and decoding (S4, S5, S6) as column expressions.

``TABLES`` declares the fields of users, items and interactions; ``encode_rows``
and ``decode_rows`` build every expression from it, so a table is described once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.exprs import TYPE_WEIGHTS

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def encode_interactions(df: DataFrame) -> DataFrame:
    """Enum -> its text, time -> ISO text (whole seconds)."""
    return df.select("user_id", "item_id", "interaction_type",
                     F.date_format("ts", ISO).alias("timestamp"), "duration_seconds", "rating")


def encode_recommendations(recs: DataFrame) -> DataFrame:
    """S4 for recommendations: score rounded to 4, confidence to 3."""
    cols = [F.col("user_id"), F.col("item_id"), F.round("score", 4).alias("score"), F.col("rank")]
    if "confidence" in recs.columns:
        cols.append(F.round("confidence", 3).alias("confidence"))
    return recs.select(*cols)


def decode_interactions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows into (decoded, rejected); unknown enum values are rejected.

    ``ts`` may be text: it is parsed, and an unparseable time stays NULL in the
    decoded output (the models then give it the 0.5 decay).
    """
    known = F.col("interaction_type").isin(*TYPE_WEIGHTS.keys())
    ok = df.where(known)
    bad = df.where(~known | F.col("interaction_type").isNull()).withColumn(
        "reason", F.lit("unknown interaction_type"))
    return ok, bad


_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def _quoted(x: Column) -> Column:
    """A string as a Python literal: double quotes only around an apostrophe without a double quote."""
    for plain, written in _ESCAPES:
        x = F.replace(x, F.lit(plain), F.lit(written))
    double = F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'")))


def list_to_text(arr: Column) -> Column:
    """Python list text form: ['a', "it's"] (what a CSV round trip of a list column gives)."""
    inner = F.array_join(F.transform(arr, _quoted), ", ")
    return F.concat(F.lit("["), F.coalesce(inner, F.lit("")), F.lit("]"))


# possessive repeats: no backtracking, so long lists cannot exhaust the regex stack
_ITEM = r"""(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")"""
_LIST = rf"(?s)\A\s*+\[\s*+(?:{_ITEM}\s*+(?:,\s*+{_ITEM}\s*+)*+,?\s*+)?+\]\s*+\z"


def _unquoted(x: Column) -> Column:
    x = F.substring(x, F.lit(2), F.length(x) - 2)
    x = F.replace(x, F.lit("\\\\"), F.lit("\u0000"))          # escaped backslashes stand aside
    for plain, written in _ESCAPES[1:]:
        x = F.replace(x, F.lit(written), F.lit(plain))
    return F.replace(F.regexp_replace(x, r"(?s)\\(.)", "$1"), F.lit("\u0000"), F.lit("\\"))


def parse_list(text: Column) -> Column:
    """The strings of "['a', "it's"]" (either quote, backslash escapes) as array<string>; anything else -> [].

    Quoted strings are found as tokens and unescaped one by one.
    """
    tokens = F.regexp_extract_all(text, F.lit(f"(?s)({_ITEM})"), F.lit(1))
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(F.regexp_like(text, F.lit(_LIST)), F.transform(tokens, _unquoted)), none)


# --- declared tables --------------------------------------------------------------------

AGE_GROUPS = ("13-17", "18-24", "25-34", "35-44", "45-54", "55+")           # fixed values
GENDERS = ("male", "female", "other", "prefer_not_to_say")                  # fixed values


@dataclass(frozen=True)
class Field:
    """One field of a table: Spark type (``list`` is array<string>, ``time`` a timestamp), what stands for a missing value, its
    allowed values, and digits kept when written."""
    name: str
    kind: str
    required: bool = False
    default: object = None
    values: tuple[str, ...] = ()
    digits: int | None = None


TABLES = {
    "users": (Field("user_id", "long", True), Field("username", "string", True), Field("age_group", "string", True, values=AGE_GROUPS),
              Field("gender", "string", True, values=GENDERS), Field("signup_date", "time", True),
              Field("preferred_categories", "list", default=()), Field("is_premium", "boolean", default=False)),
    "items": (Field("item_id", "long", True), Field("title", "string", True), Field("category", "string", True), Field("tags", "list", default=()),
              Field("release_date", "time"), Field("avg_rating", "double", default=0.0), Field("rating_count", "long", default=0),
              Field("description", "string", default=""), Field("image_url", "string", default="")),
    "interactions": (Field("user_id", "long", True), Field("item_id", "long", True),
                     Field("interaction_type", "string", True, values=tuple(TYPE_WEIGHTS)), Field("timestamp", "time", True),
                     Field("duration_seconds", "int"), Field("rating", "double")),
}


def _source(df: DataFrame, f: Field) -> Column:
    """The field's column; a table that lacks it has it null, and a time may be called ``ts``."""
    if f.name in df.columns:
        return F.col(f.name)
    return F.col("ts") if f.name == "timestamp" and "ts" in df.columns else F.lit(None).cast("string")


def _iso(c: Column) -> Column:
    """ISO text of a time: microseconds only where there are any."""
    micros = F.date_format(c, "SSSSSS")
    return F.concat(F.date_format(c, ISO), F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")))


def encode_rows(df: DataFrame, table: str) -> DataFrame:
    """The rows of a declared table in their written form (times as ISO text, lists as list text, numbers rounded)."""
    out = []
    for f in TABLES[table]:
        c = _source(df, f)
        if f.kind == "time":
            c = _iso(c.cast("timestamp_ntz"))
        elif f.kind == "list":
            c = list_to_text(c)
        elif f.digits is not None:
            c = F.round(c, f.digits)
        out.append(c.alias(f.name))
    return df.select(*out)


def _decoded(df: DataFrame, f: Field) -> tuple[Column, Column]:
    """(value, reason of a reject or null) of a field given as text or in its own type."""
    c = _source(df, f)
    kind = dict(df.dtypes).get(f.name, "string")
    if f.kind == "list":
        value = parse_list(c) if kind == "string" else c
        bad = F.lit(False) if kind != "string" else c.isNotNull() & ~F.regexp_like(c, F.lit(_LIST))
    elif f.kind == "time":
        value = F.try_to_timestamp(c).cast("timestamp_ntz") if kind == "string" else c.cast("timestamp_ntz")
        bad = c.isNotNull() & value.isNull()
    else:
        value = c.try_cast(f.kind)
        bad = c.isNotNull() & value.isNull()
        if f.values:
            bad = c.isNotNull() & ~value.isin(*f.values)
    if f.default is not None:
        none = F.array().cast("array<string>") if f.kind == "list" else F.lit(f.default)
        value = F.when(c.isNull(), none).otherwise(value)
    reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(f"{'unknown' if f.values else 'bad'} {f.name}"))
    if f.required:
        reason = F.when(c.isNull(), F.lit(f"missing {f.name}")).otherwise(reason)
    return value, reason


def decode_rows(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, rejected rows with all their ``reasons`` in field order).

    A missing optional field gets its default; a row with a missing required field, an unknown enum value or a text
    that is not of the field's type is rejected, as given, with one reason per such field.
    """
    fields = [(f, *_decoded(df, f)) for f in TABLES[table]]
    reasons = F.filter(F.array(*[r for _, _, r in fields]), lambda r: r.isNotNull())
    ok = df.where(F.size(reasons) == 0).select(*[v.alias(f.name) for f, v, _ in fields])
    return ok, df.where(F.size(reasons) > 0).select("*", reasons.alias("reasons"))
