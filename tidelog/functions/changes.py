"""Expressions over the parts of a change event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.rules import cases
from tidelog.schema import DELETE, LABELS


def op_label(op: Column, labels: Mapping[str, str] = LABELS, otherwise: str = "UNKNOWN") -> Column:
    """Readable operation name; codes outside ``labels`` (and NULL) become ``otherwise``."""
    return cases(((op == code, label) for code, label in labels.items()), otherwise)


def op_or(op: Column, default: str) -> Column:
    return F.coalesce(op, F.lit(default))


def merged(column: str, before: str = "before", after: str = "after") -> Column:
    """New value if there is one, else the old value.

    An update that sets a column to NULL shows the old value again; ``row_image`` does not.
    """
    return F.coalesce(F.col(after)[column], F.col(before)[column])


def row_image(column: str, before: str = "before", after: str = "after") -> Column:
    """The column from the whole new row, or from the old row if there is no new row."""
    return F.when(F.col(after).isNotNull(), F.col(after)[column]).otherwise(F.col(before)[column])


def record_id(parts: Sequence[Column], null_part: str | None = None, separator: str = "_") -> Column:
    """Parts joined as text. NULL if any part is NULL, unless ``null_part`` stands in for it."""
    texts = [p.cast("string") for p in parts]
    if null_part is not None:
        texts = [F.coalesce(t, F.lit(null_part)) for t in texts]
    pieces = [texts[0]]
    for text in texts[1:]:
        pieces += [F.lit(separator), text]
    return F.concat(*pieces)


def key_valid(key: Sequence[str], op: Column | None = None) -> Column:
    """True if the event names its row: the new image has a key, or a delete's old image has one."""
    op = F.col("op") if op is None else op

    def has(image: str) -> Column:
        cond = F.lit(True)
        for name in key:
            cond = cond & F.col(image)[name].isNotNull()
        return cond

    return F.coalesce(has("after") | (has("before") & (op == DELETE)), F.lit(False))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def from_micros(us: Column) -> Column:
    """Microseconds since 1970 as a timestamp cut to whole milliseconds."""
    return F.timestamp_micros(us - F.pmod(us, F.lit(1000)))


def micro_time(column: str, fallback: Column | None = None) -> Column:
    """Row time in microseconds from the new image, else the old image, else ``fallback``."""
    last = F.current_timestamp() if fallback is None else fallback
    return F.coalesce(from_micros(F.col("after")[column]), from_micros(F.col("before")[column]), last)


def unixtime_text(ms: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Milliseconds as text with whole seconds, in the session zone."""
    return F.date_format(F.date_trunc("second", F.timestamp_millis(ms)), pattern)


def connector_decimal(encoded: Column, scale: int, precision: int = 38) -> Column:
    """Decode a connector decimal: base64 of the big-endian two's complement unscaled integer.

    The hex digits are extended by their sign to one or two words of eight bytes: the first is signed,
    the second is not. So up to sixteen bytes (38 digits) decode without leaving the JVM, and numbers
    of up to eight bytes take one word. What does not fit becomes NULL.
    """
    target = f"decimal({precision},{scale})"
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    n = F.length(digits)
    sign = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")

    def signed(word: Column) -> Column:
        return F.conv(word, 16, -10).try_cast("bigint")

    short = signed(F.lpad(digits, F.lit(16), sign))
    if precision <= 18:
        step = F.lit(f"1E-{scale}").cast(f"decimal({max(scale, 1)},{scale})")
        value = short.cast("decimal(19,0)")
        return F.when(n <= 16, (value * step if scale else value).try_cast(target))
    # A negative number is taken from the next multiple above it, so that no step exceeds 38 digits.
    whole = "decimal(38,0)"
    two64 = F.lit(str(1 << 64)).cast("decimal(20,0)")
    words = F.lpad(digits, F.lit(32), sign)
    borrow = F.when(sign == "F", 1).otherwise(0)
    high = (signed(F.left(words, F.lit(16))) + borrow).cast("decimal(19,0)")
    low = F.conv(F.right(words, F.lit(16)), 16, 10).cast("decimal(20,0)") - borrow.cast("decimal(1,0)") * two64
    long = F.try_add(F.try_multiply(high, two64), low)
    unscaled = F.when(n <= 16, short.cast(whole)).when(n <= 32, long.try_cast(whole))
    # Text with an exponent is the one exact shift that keeps all 38 digits.
    return F.concat(unscaled.cast("string"), F.lit(f"E-{scale}")).try_cast(target)
