"""Queries: the mathematical and text functions over whole columns and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotstats.functions import math as m
from plotstats.functions import strings as st
from plotstats.functions.registry import register
from plotstats.plans.views import table

DIGITS = 9


def _numbers(spark, sf_dir):
    """x in [0, 0.1], y in [1, 50], z in [-4.9, 5] per row, x and z with zeros."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as k", "l_discount as x", "l_quantity as y", "(l_quantity - 25) / 5e0 as z", "l_linenumber as i"
    )


NUMBERS_SQL = (
    "(select l_orderkey as k, l_discount as x, l_quantity as y, (l_quantity - 25) / 5e0 as z, l_linenumber as i from lineitem)"
)


def _family(columns):
    """Query and SQL from {name: (Spark expression, SQL expression)}; infinite values are shown as 1e300."""

    def query(spark, sf_dir):
        c = {n: F.col(n) for n in "xyzi"}
        out = [
            F.round(F.when(v == float("inf"), 1e300).otherwise(v), DIGITS).alias(name)
            for name, (f, _) in columns.items()
            for v in [f(c)]
        ]
        return _numbers(spark, sf_dir).select("k", *out)

    sql = ", ".join(f"round({e}, {DIGITS}) as {name}" for name, (_, e) in columns.items())
    return query, f"select k, {sql} from {NUMBERS_SQL}"


TRIG = _family(
    {
        "f_acos": (lambda c: m.acos(c["z"]), "case when abs(z) <= 1 then acos(z) end"),
        "f_asin": (lambda c: m.asin(c["z"]), "case when abs(z) <= 1 then asin(z) end"),
        "f_atan": (lambda c: m.atan(c["z"]), "atan(z)"),
        "f_atan2": (lambda c: m.atan2(c["z"], c["y"]), "atan2(z, y)"),
        "f_degrees": (lambda c: m.degrees(c["z"]), "degrees(z)"),
        "f_radians": (lambda c: m.radians(c["y"]), "radians(y)"),
        "f_cos": (lambda c: m.cos(c["z"]), "cos(z)"),
        "f_sin": (lambda c: m.sin(c["z"]), "sin(z)"),
        "f_tan": (lambda c: m.tan(c["x"]), "tan(x)"),
        "f_cot": (lambda c: m.cot(c["x"]), "case when x = 0 then 1e300 else 1 / tan(x) end"),
    }
)
HYPER = _family(
    {
        "f_acosh": (lambda c: m.acosh(c["z"]), "case when z >= 1 then acosh(z) end"),
        "f_asinh": (lambda c: m.asinh(c["z"]), "asinh(z)"),
        "f_atanh": (lambda c: m.atanh(c["z"]), "case when abs(z) < 1 then atanh(z) end"),
        "f_cosh": (lambda c: m.cosh(c["z"]), "cosh(z)"),
        "f_cosh_large": (lambda c: m.cosh(c["y"] * 100) * 0, "case when y * 100 < 710 then 0 end"),
        "f_sinh": (lambda c: m.sinh(c["z"]), "sinh(z)"),
        "f_tanh": (lambda c: m.tanh(c["z"]), "tanh(z)"),
        "f_coth": (lambda c: m.coth(c["z"]), "case when z = 0 then 1e300 else 1 / tanh(z) end"),
    }
)
EXPLOG = _family(
    {
        "f_exp": (lambda c: m.exp(c["z"]), "exp(z)"),
        "f_exp_large": (lambda c: m.exp(c["z"] * 1000 + 5000) * 0, "case when z < -43e-1 then 0 end"),
        "f_log": (lambda c: m.log(c["z"]), "case when z > 0 then ln(z) end"),
        "f_log10": (lambda c: m.log10(c["z"]), "case when z > 0 then log10(z) end"),
        "f_power": (lambda c: m.power(c["y"], c["z"]) * 1e-6, "pow(y, z) * 1e-6"),
        "f_power_nan": (lambda c: m.power(c["z"], F.lit(0.5)), "case when z >= 0 then pow(z, 5e-1) end"),
        "f_sqrt": (lambda c: m.sqrt(c["z"]), "case when z >= 0 then sqrt(z) end"),
        "f_square": (lambda c: m.square(c["z"]), "z * z"),
    }
)


def math_round(spark, sf_dir):
    df = _numbers(spark, sf_dir)
    z, i = F.col("z"), F.col("i")
    return df.select(
        "k",
        m.sign(z).alias("f_sign"),
        m.sign_whole(i - 4).alias("f_sign_int"),
        m.ceil(z).alias("f_ceil"),
        m.floor(z).alias("f_floor"),
        m.square(i).cast("bigint").alias("f_square_int"),
        F.round(m.pi(), 12).alias("f_pi"),
    )


def logit_roundtrip(spark, sf_dir):
    """Cover values with 0 and 1, their logit and back, and clamped predictions."""
    df = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as k", "round(l_discount * 100) / 10 as t", "l_tax * 20 - 2e-1 as p")
    t = m.logit(F.col("t"))
    return df.select(
        "k",
        "t",
        F.round(t, DIGITS).alias("logit"),
        F.round(m.inverse_logit(t), DIGITS).alias("back"),
        F.round(m.clamp_cover(F.col("p")), DIGITS).alias("clamped"),
    )


# --- texts -----------------------------------------------------------------------------

def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _long(c):
    """Long results are compared by length and checksum."""
    return [F.length(c).cast("bigint").alias("n"), F.md5(c).alias("sum")]


def str_replicate(spark, sf_dir):
    df = _docs(spark, sf_dir)
    times = (F.col("doc_id") % 4 - 1).cast("int")
    return df.select("doc_id", *_long(st.replicate(F.col("text"), times)))


def str_charindex(spark, sf_dir):
    df = _docs(spark, sf_dir)
    text = F.col("text")
    return df.select(
        "doc_id",
        st.charindex(F.lit("th"), text).cast("bigint").alias("first_at"),
        st.charindex(F.lit("th"), text, F.lit(20)).cast("bigint").alias("later_at"),
        st.charindex(F.col("lang"), text, F.lit(0)).cast("bigint").alias("lang_at"),
        st.charindex(F.lit(""), text).cast("bigint").alias("empty_at"),
    )


def str_left_right(spark, sf_dir):
    n = (F.col("n_chars") / 2).cast("int")
    df = _docs(spark, sf_dir)
    return df.select(
        "doc_id",
        F.md5(st.leftstr(F.col("text"), n)).alias("left_half"),
        F.md5(st.rightstr(F.col("text"), n)).alias("right_half"),
    )


def str_reverse(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *_long(st.reverse(F.col("text"))))


def str_proper(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *_long(st.proper(F.col("text"))))


def str_pad(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    name, n = F.col("p_name"), (F.col("p_size") % 25).cast("int")
    return df.select(
        "p_partkey",
        st.padl(name, n).alias("padl"),
        st.padr(name, n).alias("padr"),
        st.padc(name, n).alias("padc"),
        st.padl(name, n - 5).alias("padl_short"),
    )


def str_filter(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *_long(st.strfilter(F.col("text"), F.lit("aeiou .é"))))


def str_difference(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    return df.select(
        "p_partkey",
        st.difference(F.col("p_name"), F.col("p_type")).cast("bigint").alias("name_type"),
        st.difference(F.col("p_name"), F.col("p_brand")).cast("bigint").alias("name_brand"),
        st.difference(F.col("p_name"), F.col("p_size").cast("string")).cast("bigint").alias("name_size"),
    )


def str_trim_replace(spark, sf_dir):
    df = _docs(spark, sf_dir)
    text = F.concat(F.lit("  "), F.col("text"), F.lit("  "))
    return df.select(
        "doc_id",
        F.md5(st.ltrim(text)).alias("l"),
        F.md5(st.rtrim(text)).alias("r"),
        F.md5(st.trim(text)).alias("b"),
        F.md5(st.replace(F.col("text"), F.lit("the"), F.lit("THE"))).alias("x"),
    )


def str_abbrev(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *_long(st.abbreviation(F.col("text"))))


def register_functions(spark, sf_dir):
    """The registered names, called from SQL over the part and line item tables."""
    register(spark)
    part = table(spark, sf_dir, "part").selectExpr(
        "'part' as kind",
        "p_partkey as key",
        "padc(p_name, 21) as a",
        "sound_code(p_name) as b",
        "cast(ps_difference(p_name, p_type) as string) as c",
        "round(ps_log(p_retailprice), 9) as d",
    )
    lists = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.collect_list("s_acctbal").alias("v"))
    lines = lists.selectExpr(
        "'nation' as kind",
        "cast(s_nationkey as bigint) as key",
        "replicate('ab', 2) as a",
        "proper('dry sub\thumid') as b",
        "cast(ps_charindex('b', 'abc') as string) as c",
        "round(lower_quartile_of(v), 9) as d",
    )
    return part.unionByName(lines)


def _proper_sql(x: str) -> str:
    up, low = st.UPPER, st.LOWER
    word = f"concat(translate(w[1:1], '{low}', '{up}'), w[2:])"
    part = f"array_to_string(list_transform(string_split(p, ' '), lambda w: {word}), ' ')"
    return f"array_to_string(list_transform(string_split(translate({x}, '{up}', '{low}'), chr(9)), lambda p: {part}), chr(9))"


def _sound_sql(x: str) -> str:
    letters = f"upper(regexp_replace({x}, '[^A-Za-z]', '', 'g'))"
    codes = f"regexp_replace(translate({letters}, '{st.SOUND_LETTERS}', '{st.SOUND_DIGITS}'), '[^1-6]', '', 'g')"
    return f"case when {letters} = '' then '?000' else left({letters}, 1) || rpad(left({codes}, 3), 3, '0') end"


def _difference_sql(a: str, b: str) -> str:
    return " + ".join(
        f"cast(substr({_sound_sql(a)}, {i}, 1) = substr({_sound_sql(b)}, {i}, 1) as bigint)" for i in range(1, 5)
    )


def _at(needle: str, start: int) -> str:
    return (
        f"case when instr(substr(text, {start}), {needle}) = 0 then 0"
        f" else instr(substr(text, {start}), {needle}) + {start - 1} end"
    )


def _pad_sql(f: str, n: str) -> str:
    return f"case when {n} < 0 then null when length(p_name) >= {n} then p_name else {f}(p_name, cast({n} as int), ' ') end"


_PADC = (
    "repeat(' ', cast(floor(greatest({n} - length({s}), 0) / 2) as int)) || {s} ||"
    " repeat(' ', cast(ceil(greatest({n} - length({s}), 0) / 2) as int))"
)
_TEXT_SUM = "select doc_id, cast(length({0}) as bigint) as n, md5({0}) as sum from documents"

QUERIES = {
    "math_trig": TRIG,
    "math_hyper": HYPER,
    "math_explog": EXPLOG,
    "math_round": (
        math_round,
        "select k, cast(sign(z) as double) as f_sign, cast(sign(i - 4) as bigint) as f_sign_int,"
        " cast(ceil(z) as bigint) as f_ceil, cast(floor(z) as bigint) as f_floor, cast(i * i as bigint) as f_square_int,"
        f" round(pi(), 12) as f_pi from {NUMBERS_SQL}",
    ),
    "logit_roundtrip": (
        logit_roundtrip,
        f"select k, t, round(ln(u / (1 - u)), {DIGITS}) as logit, round(1 / (1 + exp(-ln(u / (1 - u)))), {DIGITS}) as back,"
        f" round(greatest(0, least(95e-2, p)), {DIGITS}) as clamped from (select *, case t when 0 then 1e-4 when 1 then 9999e-4"
        " else t end as u from (select l_orderkey as k, round(l_discount * 100) / 10 as t, l_tax * 20 - 2e-1 as p from lineitem))",
    ),
    "str_replicate": (
        str_replicate,
        "select doc_id, cast(length(r) as bigint) as n, md5(r) as sum from (select doc_id, case when doc_id % 4 - 1 >= 0"
        " then repeat(text, doc_id % 4 - 1) end as r from documents)",
    ),
    "str_charindex": (
        str_charindex,
        f"select doc_id, cast({_at(chr(39) + 'th' + chr(39), 1)} as bigint) as first_at,"
        f" cast({_at(chr(39) + 'th' + chr(39), 20)} as bigint) as later_at, cast({_at('lang', 1)} as bigint) as lang_at,"
        " cast(0 as bigint) as empty_at from documents",
    ),
    "str_left_right": (
        str_left_right,
        "select doc_id, md5(left(text, n_chars // 2)) as left_half, md5(right(text, n_chars // 2)) as right_half from documents",
    ),
    "str_reverse": (str_reverse, _TEXT_SUM.format("reverse(text)")),
    "str_proper": (str_proper, _TEXT_SUM.format(_proper_sql("text"))),
    "str_pad": (
        str_pad,
        f"select p_partkey, {_pad_sql('lpad', 'p_size % 25')} as padl, {_pad_sql('rpad', 'p_size % 25')} as padr,"
        f" {_PADC.format(s='p_name', n='p_size % 25')} as padc, {_pad_sql('lpad', '(p_size % 25 - 5)')} as padl_short from part",
    ),
    "str_filter": (str_filter, _TEXT_SUM.format("regexp_replace(text, '[^aeiou .é]', '', 'g')")),
    "str_difference": (
        str_difference,
        f"select p_partkey, {_difference_sql('p_name', 'p_type')} as name_type,"
        f" {_difference_sql('p_name', 'p_brand')} as name_brand,"
        f" {_difference_sql('p_name', 'cast(p_size as varchar)')} as name_size from part",
    ),
    "str_trim_replace": (
        str_trim_replace,
        "select doc_id, md5(ltrim('  ' || text || '  ', ' ')) as l, md5(rtrim('  ' || text || '  ', ' ')) as r,"
        " md5(trim('  ' || text || '  ', ' ')) as b, md5(replace(text, 'the', 'THE')) as x from documents",
    ),
    "str_abbrev": (str_abbrev, _TEXT_SUM.format("regexp_replace(text, '[^A-Z]', '', 'g')")),
    "register_functions": (
        register_functions,
        f"select 'part' as kind, p_partkey as key, {_PADC.format(s='p_name', n='21')} as a, {_sound_sql('p_name')} as b,"
        f" cast({_difference_sql('p_name', 'p_type')} as varchar) as c, round(ln(p_retailprice), 9) as d from part union all"
        " select 'nation', s_nationkey, 'abab', 'Dry Sub' || chr(9) || 'Humid', '2',"
        " round((percentile_disc(0.25) within group (order by s_acctbal) + percentile_disc(0.75) within group"
        " (order by s_acctbal desc)) / 2, 9) from supplier group by s_nationkey",
    ),
}
