"""Column expressions for accounting records: timestamps in two formats, checksums, number formats, blanks.

Everything stays inside Catalyst; casts that can fail are try_ variants, so bad input gives null under ANSI mode too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number formats that coexist: in accounting records, in requests, and in the number plan (with the plus sign).
E164_RECORD = r"^\+[1-9][0-9]{1,14}$"
E164_REQUEST = r"^\+[1-9][0-9]{6,14}$"
E164_PLAN = r"^\+[0-9]{10,15}$"


def parse_ts(c: Column) -> Column:
    """Epoch-second digits or ISO-8601 text as TIMESTAMP; a `Z` after an explicit offset is dropped; null if neither."""
    text = F.trim(c)
    iso = F.regexp_replace(text, r"([+-][0-9]{2}:[0-9]{2})Z$", "$1")
    digits = text.rlike(r"^[0-9]+$")
    return F.when(digits, F.timestamp_seconds(F.when(digits, text).try_cast("bigint"))).when(text.contains("T"), F.try_to_timestamp(iso))


def trimmed(c: Column) -> Column:
    """The text without blanks at both ends; null counts as empty."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def nullif_blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


#: What two digits add to a Luhn sum if the second one is doubled, and its digits added: fixed values, by the two digits' number.
_LUHN_PAIRS = [p // 10 + 2 * (p % 10) // 10 + 2 * (p % 10) % 10 for p in range(100)]


def luhn_digit(body: Column) -> Column:
    """The check digit for 14 digits: every second digit from the right is doubled, and its digits added.

    Two digits at a time, looked up by plain expressions, which Spark compiles; a lambda over digits would be interpreted.
    """
    worth = F.array(*[F.lit(w) for w in _LUHN_PAIRS])
    first, *others = [F.get(worth, F.substring(body, i, 2).cast("int")) for i in range(1, 15, 2)]
    return ((10 - sum(others, first) % 10) % 10).cast("string")


def apart(c: Column) -> Column:
    """c as it is, for one short column of a large projection.

    Spark evaluates a projection that has a lambda outside of its stage's one generated method, in compiled methods of its own.
    Within a stage of many joins, that one method would pass the 8000 bytes beyond which the JVM leaves it uncompiled.
    """
    return F.get(F.transform(F.array(c), lambda x: x), F.lit(0))


def by_hash(c: str) -> list[Column]:
    """c as a window's key, after its hash: a sort compares 8 bytes of its first key in place, and sessions, numbers and identities share those."""
    return [F.xxhash64(c), F.col(c)]


def luhn_ok(imei: Column) -> Column:
    return imei.rlike("^[0-9]{15}$") & F.coalesce(F.call_function("luhn_check", imei), F.lit(False))


def tac_of(imei: Column) -> Column:
    return F.substring(imei, 1, 6)


def epoch(c: Column) -> Column:
    return F.unix_seconds(c)


def place(*parts: Column) -> Column:
    """Text that sorts as the parts do one after the other; numbers (not negative) are padded."""
    return F.concat_ws("/", *parts)


def padded(c: Column, n: int = 19) -> Column:
    return F.lpad(c.cast("string"), n, "0")
