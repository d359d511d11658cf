"""The function library under its SQL names, as SQL functions of a session.

Every function is an expression that Spark inlines into the plan; no Python worker
is involved. Aggregates are registered the same way, over an ARRAY of values
collected by the caller's grouping, or built with `plotstats.operators.aggregates`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from plotstats.functions.strings import LOWER, SOUND_CHARACTERS, SOUND_DIGITS, UPPER


def _finite(e: str) -> str:
    return f"case when not isnan({e}) and abs({e}) < double('infinity') then {e} end"


_ONE_REAL = {
    name: _finite(f"{name}(x)")
    for name in (
        "acos asin atan sin cos tan sinh cosh tanh asinh acosh atanh exp log10 sqrt degrees radians".split()
    )
}

_SOUND_BYTES = "regexp_replace(decode(encode(s, 'UTF-8'), 'ISO-8859-1'), '^[^A-Za-z]+|[0-9]', '')"

# name -> (parameters, return type, body). Names that Spark already has are given
# the prefix `ps_`, because a session function would otherwise call itself.
SCALARS: dict[str, tuple[str, str, str]] = {
    **{f"ps_{name}": ("x DOUBLE", "DOUBLE", body) for name, body in _ONE_REAL.items()},
    "ps_log": ("x DOUBLE", "DOUBLE", _finite("ln(x)")),
    "ps_atan2": ("y DOUBLE, x DOUBLE", "DOUBLE", _finite("atan2(y, x)")),
    "atn2": ("y DOUBLE, x DOUBLE", "DOUBLE", _finite("atan2(y, x)")),
    "ps_cot": ("x DOUBLE", "DOUBLE", "case when x = 0 then double('infinity') else try_divide(1D, tan(x)) end"),
    "coth": ("x DOUBLE", "DOUBLE", "case when x = 0 then double('infinity') else try_divide(1D, tanh(x)) end"),
    "ps_power": ("x DOUBLE, y DOUBLE", "DOUBLE", _finite("pow(x, y)")),
    "ps_sign": ("x DOUBLE", "DOUBLE", "signum(x)"),
    "square": ("x DOUBLE", "DOUBLE", "x * x"),
    # a session function has one signature, so whole numbers have names of their own
    "ps_sign_whole": ("x BIGINT", "BIGINT", "cast(signum(x) as bigint)"),
    "square_whole": ("x BIGINT", "BIGINT", "try_multiply(x, x)"),
    "ps_ceil_whole": ("x BIGINT", "BIGINT", "x"),
    "ps_floor_whole": ("x BIGINT", "BIGINT", "x"),
    "ps_ceil": ("x DOUBLE", "BIGINT", "cast(ceil(x) as bigint)"),
    "ps_floor": ("x DOUBLE", "BIGINT", "cast(floor(x) as bigint)"),
    "ps_pi": ("", "DOUBLE", "pi()"),
    "replicate": (
        "s STRING, n INT",
        "STRING",
        "case when coalesce(n, 0) >= 0 then repeat(s, coalesce(n, 0)) end",
    ),
    "ps_charindex": (
        "needle STRING, hay STRING, start INT DEFAULT 1",
        "INT",
        "case when needle is null or hay is null then null when needle = '' then 0"
        " else locate(needle, hay, greatest(coalesce(start, 0), 1)) end",
    ),
    "leftstr": ("s STRING, n INT", "STRING", "left(s, n)"),
    "rightstr": ("s STRING, n INT", "STRING", "right(s, n)"),
    "ps_reverse": ("s STRING", "STRING", "reverse(s)"),
    "proper": (
        "s STRING",
        "STRING",
        f"array_join(transform(split(translate(s, '{UPPER}', '{LOWER}'), '\\t'), p -> array_join(transform("
        f"split(p, ' '), w -> concat(translate(left(w, 1), '{LOWER}', '{UPPER}'), substring(w, 2))), ' ')), '\\t')",
    ),
    "padl": (
        "s STRING, n INT",
        "STRING",
        "case when coalesce(n, 0) < 0 then null when length(s) >= coalesce(n, 0) then s"
        " else lpad(s, coalesce(n, 0), ' ') end",
    ),
    "padr": (
        "s STRING, n INT",
        "STRING",
        "case when coalesce(n, 0) < 0 then null when length(s) >= coalesce(n, 0) then s"
        " else rpad(s, coalesce(n, 0), ' ') end",
    ),
    "padc": (
        "s STRING, n INT",
        "STRING",
        "case when coalesce(n, 0) >= 0 then concat("
        "repeat(' ', cast(floor(greatest(coalesce(n, 0) - length(s), 0) / 2) as int)), s,"
        " repeat(' ', cast(ceil(greatest(coalesce(n, 0) - length(s), 0) / 2) as int))) end",
    ),
    "strfilter": ("s STRING, keep STRING", "STRING", "translate(s, translate(s, keep, ''), '')"),
    "sound_code": (
        "s STRING",
        "STRING",
        "case when s rlike '[A-Za-z]' then "
        f"upper(left({_SOUND_BYTES}, 1)) || rpad(left(regexp_replace(translate({_SOUND_BYTES}, "
        f"'{SOUND_CHARACTERS}', '{SOUND_DIGITS * 4}'), '[^1-6]', ''), 3), 3, '0')"
        " when s is not null then '?000' end",
    ),
    "ps_difference": (
        "a STRING, b STRING",
        "INT",
        "cast("
        + " + ".join(
            f"if(substring(sound_code(a), {i}, 1) = substring(sound_code(b), {i}, 1), 1, 0)" for i in range(1, 5)
        )
        + " as int) + if(a is null or b is null, null, 0)",
    ),
    "abbreviation": ("s STRING", "STRING", "regexp_replace(s, '[^A-Z]', '')"),
}

# Aggregates as functions of the collected, non-null values of a group.
_SORTED = "sort_array(filter(v, x -> x is not null))"


def _quartile(k: int) -> str:
    low = f"get({_SORTED}, cast(floor((size({_SORTED}) * {k} + 3) / 4) as int) - 1)"
    high = f"get({_SORTED}, cast(floor(size({_SORTED}) * {k} / 4) as int))"
    return f"({low} + {high}) / 2"


# One pass each: the spread by running means, the mode by the runs of the sorted values.
_KNOWN = "filter(v, x -> x is not null)"
_NEXT_MEAN = "a.mean + (x - a.mean) / (a.n + 1D)"
_VARIANCE = (
    f"aggregate({_KNOWN}, named_struct('n', 0D, 'mean', 0D, 'm2', 0D), (a, x) -> named_struct('n', a.n + 1D, 'mean', {_NEXT_MEAN},"
    f" 'm2', a.m2 + (x - a.mean) * (x - ({_NEXT_MEAN}))), a -> case when a.n > 1D then a.m2 / (a.n - 1D) else 0D end)"
)
_RUN = "if(x <=> a.x, a.run + 1, 1)"
_MODE = (
    f"aggregate(sort_array(transform({_KNOWN}, x -> x + 0D)), named_struct('x', cast(null as double), 'run', 0, 'most', 0, 'top', cast(null as double), 'ties', 0),"
    f" (a, x) -> named_struct('x', x, 'run', {_RUN}, 'most', greatest(a.most, {_RUN}), 'top', if({_RUN} > a.most, x, a.top),"
    f" 'ties', if({_RUN} > a.most, 1, a.ties + if({_RUN} = a.most, 1, 0))), a -> if(a.ties = 1, a.top, null))"
)

ARRAY_AGGREGATES: dict[str, str] = {
    "mode_of": _MODE,
    "variance_of": _VARIANCE,
    "stdev_of": f"sqrt({_VARIANCE})",
    "median_of": _quartile(2),
    "lower_quartile_of": _quartile(1),
    "upper_quartile_of": _quartile(3),
}


def register(spark: SparkSession) -> list[str]:
    """Creates the functions in the session and returns their names."""
    for name, (params, kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {kind} RETURN {body}")
    for name, body in ARRAY_AGGREGATES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v ARRAY<DOUBLE>) RETURNS DOUBLE RETURN {body}")
    return [*SCALARS, *ARRAY_AGGREGATES]
