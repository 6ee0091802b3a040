"""Column builders.  Each returns a ``Column``; nothing here runs a job.

Every parse is a ``try_`` form so ANSI mode never raises on dirty input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.constants import (
    DATE_FORMATS, DAY, DAY_START_HOUR, NIGHT, NIGHT_START_HOUR,
)


def free_name(wanted: str, taken: Sequence[str]) -> str:
    """``wanted``, lengthened until no column of ``taken`` has it (Spark ignores case)."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(df_or_types, *cols: str) -> Column:
    """True when every column is non-NULL (and not NaN for float columns).

    The same rows ``dropna(subset=cols)`` keeps, written as ``IS NOT NULL``
    conjunctions so the null checks reach a Parquet scan as pushed filters.
    """
    types = dict((f.name, f.dataType) for f in df_or_types.schema.fields) \
        if hasattr(df_or_types, "schema") else dict(df_or_types)
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull()
        if isinstance(types.get(c), (T.FloatType, T.DoubleType)):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return F.lit(True) if cond is None else cond


def title_case(c: str | Column) -> Column:
    """Trim, then capitalise the first letter of every blank-separated word."""
    return F.initcap(F.trim(_col(c)))


_FIXED_WIDTH = {"MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}


def _tokens(fmt: str) -> list[tuple[str, int | None]] | None:
    """Pattern -> [(literal, 1) | (field, width or None if variable)]; None if unsupported."""
    out, i = [], 0
    while i < len(fmt):
        j = i
        while j < len(fmt) and fmt[j] == fmt[i]:
            j += 1
        run = fmt[i:j]
        if run[0].isalpha():
            if run in _FIXED_WIDTH:
                out.append((run, _FIXED_WIDTH[run]))
            elif set(run) == {"y"} and len(run) >= 4:
                out.append((run, None))
            else:
                return None
        else:
            out += [(ch, 1) for ch in run]
        i = j
    return out


def shape_guard(text: Column, fmt: str) -> Column | None:
    """A cheap test every string ``fmt`` can parse passes (a superset).

    Built by rule from the pattern: each literal character must sit where
    the pattern puts it, counted from the start when the fields before it
    have fixed width (``MM``, ``dd``, ``HH``, ``mm``, ``ss``), else from the
    end when the fields after it do (a ``yyyy`` field has variable width).
    A few character tests instead of a parse attempt that raises and
    catches an exception on every non-matching row.  None when no literal
    can be placed.
    """
    toks = _tokens(fmt)
    if toks is None:
        return None
    cond = None
    for i, (tok, width) in enumerate(toks):
        if tok[0].isalpha():
            continue
        before, after = toks[:i], toks[i + 1:]
        if all(w is not None for _, w in before):
            pos = sum(w for _, w in before) + 1
        elif all(w is not None for _, w in after):
            pos = -(sum(w for _, w in after) + 1)
        else:
            continue
        test = F.substring(text, pos, 1) == F.lit(tok)
        cond = test if cond is None else cond & test
    return cond


def parse_date(c: str | Column, source_type: T.DataType | None = None,
               formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date from text: each format tried on the ORIGINAL text, first match wins,
    then a plain date cast as the last resort.  Dates and timestamps pass through.

    Each format's parser only sees text of its shape (``shape_guard``).
    """
    if isinstance(source_type, T.DateType):
        return _col(c)
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(_col(c))
    text = _col(c).cast("string")
    tries = []
    for fmt in formats:
        guard = shape_guard(text, fmt)
        parsed = F.try_to_date(text, fmt)
        tries.append(parsed if guard is None else F.when(guard, parsed))
    return F.coalesce(*tries, text.try_cast("date"))


def parse_hour(c: str | Column, source_type: T.DataType | None = None) -> Column:
    """Hour of an ``HH:mm`` time; otherwise the integer before the first ``:``.

    The two rules give one result: a strict ``HH:mm`` parse succeeds only on
    exactly two digits, a colon and two digits (hour <= 23, minute <= 59),
    and then its hour IS the integer before the colon.  So the integer
    before the first ``:`` is computed directly, without a timestamp parse
    per row (tests check the equivalence against the two-rule form).
    """
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)):
        return F.hour(_col(c))
    text = _col(c).cast("string")
    return F.split(text, ":").getItem(0).try_cast("int")


def period(hour: str | Column, day: str = DAY, night: str = NIGHT) -> Column:
    """``day`` for 6 <= hour < 18, else ``night`` (NULL hour is night)."""
    h = _col(hour)
    return F.when((h >= DAY_START_HOUR) & (h < NIGHT_START_HOUR), F.lit(day)).otherwise(F.lit(night))


def share(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Percentage ``part / whole * 100`` rounded (Spark HALF_UP); NULL when whole is 0."""
    return F.round(F.try_divide(_col(part), _col(whole)) * 100, digits)


def hour_label(hour: str | Column) -> Column:
    """``HH:00`` text of an hour."""
    return F.format_string("%02d:00", _col(hour))


def mode_of(key: str | Column, count: str | Column, where: Column | None = None) -> Column:
    """Aggregate: the key with the largest count, ties to the smallest key.

    Runs over already-grouped counts (small), never over raw values.
    NULL keys are not candidates; rows failing ``where`` are ignored.
    """
    k = _col(key)
    cond = k.isNotNull() if where is None else (where & k.isNotNull())
    return F.min_by(k, F.when(cond, F.struct((-_col(count)).alias("neg"), k.alias("key"))))
