"""Column builders for business keys, hash keys and hashdiffs.

Every builder returns a pyspark ``Column`` made only of built-in functions
(``cast``, ``substring``, ``trim``, ``coalesce``, ``concat_ws``, ``md5``), so a
stage projection stays inside a single whole-stage-codegen span and never
leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the loader we reproduce, or hash keys and
# hashdiffs stop matching rows that are already in a vault.
#   zero key for a NULL or missing business key ...... "-1"
#   separator inside composite keys and hash input ... "|"
#   text width of every key / attribute column ....... 256
#   tenant and key-collision code when none is given . "default"
#   open end of an effectivity record ................ 9999-12-31 00:00:00
# ---------------------------------------------------------------------------
ZERO_KEY = "-1"
KEY_DELIMITER = "|"
MAX_VARCHAR = 256
DEFAULT_CODE = "default"
HIGH_DATE = "9999-12-31 00:00:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(df: DataFrame, name: str) -> Column:
    """Text rendering of a source column, as an explicit cast to text prints it.

    Arrays print as ``{a,b}`` (element NULLs as ``NULL``); everything else is
    a plain cast to string. Doubles print the Spark way (``100.0``); cast them
    in the source if another rendering is wanted.
    """
    dtype = df.schema[name].dataType
    c = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(dtype, T.ArrayType):
        joined = F.array_join(c.cast("array<string>"), ",", "NULL")
        return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("{"), joined, F.lit("}"))
        )
    if isinstance(dtype, T.StringType):
        return c
    return c.cast("string")


def output_text(df: DataFrame, name: str) -> Column:
    """Text rendering of a column inside a concatenation: there the database
    prints a boolean as ``t`` / ``f`` and binary data as ``\\x`` and hex digits."""
    dtype = df.schema[name].dataType
    c = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "t").when(~c, "f")
    if isinstance(dtype, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    return text_of(df, name)


def bounded_text(c: Column | str, width: int = MAX_VARCHAR) -> Column:
    """``x::varchar(width)`` — an explicit cast cuts the text to ``width``."""
    return F.substring(_col(c).cast("string"), 1, width)


def key_text(c: Column | str, width: int = MAX_VARCHAR) -> Column:
    """Normalised key part: bounded, space-trimmed, NULL -> zero key.

    Only spaces are trimmed (tabs and newlines stay) and a blank key stays
    ``''``; only NULL becomes the zero key.
    """
    return F.coalesce(F.trim(bounded_text(c, width)), F.lit(ZERO_KEY))


def whole_key_text(c: Column | str, width: int = MAX_VARCHAR) -> Column:
    """Like ``key_text``, but a key wider than ``width`` is an error: cutting it
    would merge two entities."""
    whole = F.trim(_col(c).cast("string"))
    too_wide = F.raise_error(F.concat(F.lit(f"business key wider than {width} characters: "), F.substring(whole, 1, 64)))
    return F.coalesce(F.when(F.length(whole) > width, too_wide.cast("string")).otherwise(whole), F.lit(ZERO_KEY))


def zero_key() -> Column:
    return F.lit(ZERO_KEY)


def business_key(parts: Iterable[Column]) -> Column:
    """Composite business key: the normalised parts joined with ``|``."""
    return F.concat_ws(KEY_DELIMITER, *parts)


def hash_key(parts: Iterable[Column], tenant: str, bkeycode: str) -> Column:
    """Salted hash key: ``md5(tenant | bkeycode | part1 | part2 ...)``."""
    return F.md5(F.concat_ws(KEY_DELIMITER, F.lit(tenant), F.lit(bkeycode), *parts))


def plain_hash(parts: Iterable[Column]) -> Column:
    """Unsalted hash ``md5(part1 | part2 ...)``."""
    return F.md5(F.concat_ws(KEY_DELIMITER, *parts))


def hashdiff(parts: Iterable[Column], null_as_empty: bool = False) -> Column:
    """Change-detection hash over attribute texts.

    ``concat_ws`` skips NULLs, so (a, NULL, b) and (a, b, NULL) collide; with
    ``null_as_empty`` every NULL becomes ``''`` first and keeps its position.
    """
    parts = list(parts)
    if null_as_empty:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    return F.md5(F.concat_ws(KEY_DELIMITER, *parts))


def packed_digest(c: Column | str) -> Column:
    """A text of 32 lower-case hex digits as its 16 bytes, half as much to shuffle; any other text as 17 zero
    bytes and its own. Equal only for equal texts; digests keep their order. ``digest_text`` reads it back."""
    c = _col(c)
    # Any other text has no bytes: a letter that is no hex digit makes them NULL.
    raw = F.when((F.length(c) == 32) & (F.lower(c) == c), F.unhex(c))
    return F.coalesce(raw, F.concat(F.unhex(F.lit("00" * 17)), c.cast("binary")))


def digest_text(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.length(c) == 16, F.lower(F.hex(c))).otherwise(F.substring(c, 18, 1 << 30).cast("string"))


def _computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` replaced, as generated columns: no filter is pushed beneath them, so what they are made of
    is computed once and never copied into the conditions of a scan."""
    if not columns:
        return df
    made = df.select("*", F.explode(F.array(F.struct(*[e.alias(c) for c, e in columns.items()]))).alias("_computed"))
    return made.select(*[F.col(f"_computed.`{c}`") if c in columns else F.col(f"`{c}`") for c in df.columns])


def pack(df: DataFrame, columns: list[str], diff: str | None = None, attrs: list[str] | None = None) -> DataFrame:
    """Digests as their bytes. A ``diff`` that is the plain hashdiff of its row's ``attrs``, texts all, has no bytes at all:
    ``unpack`` and ``whole_digest`` make it from them again."""
    packed = {c: packed_digest(c) for c in columns}
    if diff in packed and attrs:
        packed[diff] = F.when(F.col(diff) == hashdiff([F.col(a) for a in attrs]), F.unhex(F.lit(""))).otherwise(packed[diff])
    return _computed_once(df, packed)


def unpack(df: DataFrame, columns: list[str], diff: str | None = None, attrs: list[str] | None = None) -> DataFrame:
    text = {c: digest_text(c) for c in columns}
    if diff in text and attrs:
        text[diff] = F.when(F.length(diff) == 0, hashdiff([F.col(a) for a in attrs])).otherwise(text[diff])
    return _computed_once(df, text)


def whole_digest(diff: str, attrs: list[str]) -> Column:
    """The bytes of a packed ``diff``, also where ``pack`` left them out."""
    return F.when(F.length(diff) == 0, F.unhex(hashdiff([F.col(a) for a in attrs]))).otherwise(F.col(diff))


def text_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def timestamp_literal(value) -> Column:
    """A run-level timestamp as a ``timestamp_ntz`` literal (folded by Catalyst)."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def high_date() -> Column:
    return timestamp_literal(HIGH_DATE)
