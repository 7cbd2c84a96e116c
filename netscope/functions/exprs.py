"""Pure ``Column`` expressions (no actions, no UDFs).

Everything here compiles to Catalyst expressions, so it stays inside
whole-stage codegen and is evaluated on executors.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- casts

def safe_double(c) -> Column:
    """Best-effort float: NULL, blank or unparsable text -> NULL (ANSI-safe)."""
    c = _c(c)
    return F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("double")


def safe_bigint(c) -> Column:
    c = _c(c)
    return F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("bigint")


def epoch_to_ts(c) -> Column:
    """Epoch seconds (any type, text allowed) -> TIMESTAMP; bad -> NULL."""
    return F.timestamp_seconds(safe_bigint(c))


def ts_to_epoch(c) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> whole epoch seconds (floor)."""
    return F.unix_seconds(_c(c).cast("timestamp"))


def ts_text(c) -> Column:
    """Timestamp rendered as ``yyyy-MM-dd HH:mm:ss`` (stable across engines)."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")


def ints_to_double(df):
    """Every integral column of ``df`` cast to double."""
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return df.select([F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, integral)
                      else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------- coalesces and pairs

def falsy_coalesce(*cols, numeric: bool = False) -> Column:
    """Python ``a or b``: NULL, '' (or 0 for numbers) fall through to the next value."""
    empty = F.lit(0) if numeric else F.lit("")
    return F.coalesce(*[F.nullif(_c(c), empty) for c in cols])


def region_pair(snd, rcv, sep: str = "->") -> Column:
    """``snd->rcv``; NULL when either side is NULL or empty."""
    return F.concat(F.nullif(_c(snd), F.lit("")), F.lit(sep), F.nullif(_c(rcv), F.lit("")))


def pair_na(a, b, sep: str = "->", na: str = "NA") -> Column:
    """Pair with a placeholder for missing sides (never NULL)."""
    return F.concat(F.coalesce(_c(a).cast("string"), F.lit(na)), F.lit(sep),
                    F.coalesce(_c(b).cast("string"), F.lit(na)))


def arrow_pair(a, b) -> Column:
    """NULL-propagating pair with the `` → `` separator."""
    return F.concat(_c(a), F.lit(" → "), _c(b))


# ---------------------------------------------------------------- paths and regexes

def path_segment(path, root_pattern: str, default: str = "Unknown") -> Column:
    """First path segment after ``root_pattern`` (a regex), else ``default``."""
    seg = F.regexp_extract(_c(path), root_pattern + r"([^/]+)/", 1)
    return F.coalesce(F.nullif(seg, F.lit("")), F.lit(default))


def regex_or_default(c, pattern: str, group: int = 1, default: str | None = None) -> Column:
    """``regexp_extract`` with a default for no match (Spark returns '')."""
    v = F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))
    return F.coalesce(v, F.lit(default)) if default is not None else v


def split_first(c, sep: str = "_", missing: str = "UNKNOWN") -> tuple[Column, Column]:
    """Split on the first ``sep``: (head, tail); no separator -> (whole, ``missing``)."""
    c = _c(c)
    pos = F.instr(c, sep)
    head = F.substring_index(c, sep, 1)
    tail = F.when(pos > 0, c.substr(pos + F.lit(len(sep)), F.length(c))).otherwise(F.lit(missing))
    return head, tail


def map_values(c, mapping: Mapping[str, str]) -> Column:
    """Dict lookup with pass-through default (``d.get(k, k)``) on a small literal map."""
    if not mapping:
        return _c(c)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[_c(c)], _c(c))


# ---------------------------------------------------------------- numbers

def finite_or_null(c) -> Column:
    """NaN and +-inf -> NULL (Spark aggregates are poisoned by NaN)."""
    c = _c(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(math.inf)), F.lit(None).cast("double")).otherwise(c.cast("double"))


# ---------------------------------------------------------------- calendar

def calendar_parts(ts) -> dict[str, Column]:
    """hour, day of week with Monday=0, date text, day name."""
    ts = _c(ts)
    return {
        "hour": F.hour(ts),
        "dow": F.weekday(ts),
        "day": F.to_date(ts).cast("string"),
        "day_name": F.date_format(ts, "EEEE"),
    }


# ---------------------------------------------------------------- arrays

def array_mean(c) -> Column:
    """Mean of a non-empty numeric array (NULL when empty or NULL)."""
    c = _c(c)
    total = F.aggregate(c, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(c) > 0, total / F.size(c))


def array_count(c) -> Column:
    c = _c(c)
    return F.when(F.size(c) > 0, F.size(c))


# ---------------------------------------------------------------- filters

_OPS = {"=", "==", "!=", "<", "<=", ">", ">=", "in", "not in"}


def _pred(t: Sequence) -> Column:
    name, op, val = t
    op = op.lower()
    if op not in _OPS:
        raise ValueError(f"unsupported filter operator {op!r}")
    c = F.col(name)
    if op in ("=", "=="):
        return c == F.lit(val)
    if op == "!=":
        return c != F.lit(val)
    if op == "<":
        return c < F.lit(val)
    if op == "<=":
        return c <= F.lit(val)
    if op == ">":
        return c > F.lit(val)
    if op == ">=":
        return c >= F.lit(val)
    if op == "in":
        return c.isin(list(val))
    return ~c.isin(list(val))


def dnf(filters) -> Column | None:
    """Filter tuples -> Column: a list of tuples is an AND, a list of such lists an OR."""
    if not filters:
        return None
    if isinstance(filters[0], (list,)) and filters[0] and isinstance(filters[0][0], (list, tuple)):
        groups = filters
    else:
        groups = [filters]
    out = None
    for g in groups:
        conj = None
        for t in g:
            p = _pred(t)
            conj = p if conj is None else conj & p
        out = conj if out is None else out | conj
    return out


# ---------------------------------------------------------------- schema helpers

def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalize_columns(df):
    new = [normalize_name(c) for c in df.columns]
    dup = {n for n in new if new.count(n) > 1}
    if dup:
        raise ValueError(f"column names collide after normalisation: {sorted(dup)}")
    return df.toDF(*new)


def check_schema(df, wanted: Mapping[str, str | None]):
    """``df`` itself if it has every wanted column (with the given Spark type, where one is given);
    otherwise one error that lists all that is absent or of another type.  Works on the plan alone."""
    have = dict(df.dtypes)
    faults = [f"{name}: absent" for name in wanted if name not in have]
    faults += [f"{name}: {have[name]} instead of {kind}" for name, kind in wanted.items()
               if kind and name in have and have[name] != kind]
    if faults:
        raise ValueError("input does not fit (" + "; ".join(faults) + ")")
    return df


def split_numeric_categorical(df) -> tuple[list[str], list[str]]:
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return num, cat


def correlation_candidates(df, limit: int | None = None,
                           exclude_tokens: Sequence[str] = ("id", "index", "filepath")) -> list[str]:
    """Numeric columns without an excluded whole ``_``-token in the name (the first ``limit``, if given)."""
    num, _ = split_numeric_categorical(df)
    keep = [c for c in num if not set(c.lower().split("_")) & set(exclude_tokens)]
    return keep[:limit]
