"""Every converter over text made from the whole orders table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import convert as cv
from workload.roles import table

# text per order and row kind: (Spark expression, DuckDB expression)
_DATE_FORMS = [
    ("MM/dd/yyyy HH:mm:ss", "%m/%d/%Y %H:%M:%S"), ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("M/d/yyyy H:m", "%-m/%-d/%Y %-H:%-M"), ("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M"), ("MM/dd/yyyy", "%m/%d/%Y"),
    ("yyyy-MM-dd", "%Y-%m-%d"), ("dd/MM/yyyy", "%d/%m/%Y"), ("yyyy/MM/dd", "%Y/%m/%d"), ("MM-dd-yyyy", "%m-%d-%Y"),
    ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"),
]
_DATE_JUNK = ["", " NULL ", "02/30/1997 01:02:03", "NONE", "soon", " 1997-01-02 ", "1997-13-01", " 01/02/1997 03:04:05 "]
_NUMBER_TEXT = [
    "cast(cast(o_totalprice as decimal(12,2)) as string)", "cast(o_custkey as string)", "'-' || cast(o_custkey as string)",
    "''", "' 12 '", "'1.0'", "'1.9'", "'-2.5'", "'NULL'", "'N/A'", "'none'", "'null'", "'1d'", "'x'", "'1e3'", "'+7'",
    "'.5'", "'5.'", "cast(null as string)",
]
_FLAG_TEXT = ["'true'", "'T'", "'1'", "'yes'", "'Y'", "'FALSE'", "'f'", "'0'", "'no'", "''", "'maybe'", "' y '", "'2'",
              "'1.9'", "'NULL'", "o_orderstatus", "cast(null as string)"]
_WORD_TEXT = ["o_orderpriority", "'  ' || o_orderpriority || ' '", "''", "'NULL'", "' N/A '", "'none'", "'   '",
              "cast(null as string)", "'Order ' || cast(o_orderkey as string)"]
_BOAT_TEXT = ["'BOAT-' || cast(o_custkey as string)", "'1_2'", "'___'", "'abc'", "''", "'_1'", "'1__2'", "'7_'",
              "cast(null as string)", "cast(o_custkey as string) || ' ft'"]


def _cases(texts) -> str:
    arms = " ".join(f"when {i} then {t}" for i, t in enumerate(texts))
    return f"case o_orderkey % {len(texts)} {arms} end"


def _dates(duck: bool) -> str:
    ts = "(o_orderdate + to_hours(o_orderkey % 24))" if duck else "(o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int)))"
    if duck:
        made = [f"strftime({ts}, '{d}')" for _, d in _DATE_FORMS]
    else:
        made = ["date_format({}, '{}')".format(ts, s.replace("'", "\\'")) for s, _ in _DATE_FORMS]
    return _cases(made + [f"'{j}'" for j in _DATE_JUNK])


_INPUT = {
    "dates": (_dates(False), _dates(True)),
    **{k: (_cases(v), _cases(v)) for k, v in
       {"numbers": _NUMBER_TEXT, "flags": _FLAG_TEXT, "words": _WORD_TEXT, "boats": _BOAT_TEXT}.items()},
}


def _query(kind: str, **columns):
    def run(spark, sf):
        raw = table(spark, sf, "orders").select("o_orderkey", F.expr(_INPUT[kind][0]).alias("raw"))
        return raw.select("o_orderkey", "raw", *[f(F.col("raw")).alias(n) for n, f in columns.items()])

    return run


def _oracle(kind: str, **columns) -> str:
    made = ", ".join(f"{e} as {n}" for n, e in columns.items())
    return f"select o_orderkey, raw, {made} from (select o_orderkey, {_INPUT[kind][1]} as raw from orders) t"


# DuckDB side
_F = {
    "m/d/Y H:M:S": "%m/%d/%Y %H:%M:%S", "Y-m-d H:M:S": "%Y-%m-%d %H:%M:%S", "Y-m-dTH:M:S": "%Y-%m-%dT%H:%M:%S",
    "m/d/Y H:M": "%m/%d/%Y %H:%M", "Y-m-d H:M": "%Y-%m-%d %H:%M", "m/d/Y": "%m/%d/%Y", "d/m/Y": "%d/%m/%Y",
    "Y-m-d": "%Y-%m-%d", "Y/m/d": "%Y/%m/%d", "m-d-Y": "%m-%d-%Y",
}
_NUM = r"regexp_full_match(trim({0}), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')"
_INT = "regexp_full_match(trim({0}), '[+-]?[0-9]+')"
_NULLISH = "(raw is null or trim(raw) in ('', 'NULL', 'N/A', 'NONE'))"
_NULLISH_ANY = "(raw is null or upper(trim(raw)) in ('', 'NULL', 'N/A', 'NONE'))"
_num = f"case when {_NUM.format('raw')} then cast(trim(raw) as double) end"
_int = f"case when {_INT.format('raw')} then cast(trim(raw) as bigint) end"


def _strp(c: str, *notations: str) -> str:
    # a text with blanks at its ends is no date for the converters
    tries = ", ".join(f"try_strptime({c}, '{_F[n]}')" for n in notations)
    return f"case when {c} = trim({c}) then coalesce({tries}) end"


# Which notations each converter knows, in the order it tries them; written out here, so that a slip there shows.
_STAMP = ("m/d/Y H:M:S", "Y-m-d H:M:S", "m/d/Y H:M", "Y-m-d H:M")
_DATE = ("Y-m-d", "m/d/Y", "d/m/Y", "Y/m/d", "m-d-Y")
_PERSON_STAMP = ("Y-m-d H:M:S", "m/d/Y H:M:S", "m/d/Y", "Y-m-d", "d/m/Y", "Y/m/d", "m-d-Y")
_PERSON_DATE = ("m/d/Y H:M:S", "m/d/Y", "Y-m-d", "d/m/Y", "Y/m/d", "m-d-Y")
_ISO_STAMP = ("m/d/Y H:M:S", "Y-m-d H:M:S", "Y-m-dTH:M:S", "m/d/Y", "Y-m-d")
_true, _false = "('TRUE', '1', 'YES', 'Y')", "('FALSE', '0', 'NO', 'N')"

QUERIES = {
    "cv_stamp": _query("dates", value=cv.stamp),
    "cv_day": _query("dates", value=cv.day),
    "cv_person_stamp": _query("dates", value=cv.person_stamp),
    "cv_person_day": _query("dates", value=cv.person_day),
    "cv_iso_stamp": _query("dates", value=cv.iso_stamp, short_words=lambda c: cv.iso_stamp(c, ("", "NULL"))),
    "cv_trimmed_stamp": _query("dates", value=cv.trimmed_stamp),
    "cv_number_or_zero": _query("numbers", value=cv.number_or_zero),
    "cv_whole": _query("numbers", value=cv.whole),
    "cv_flag": _query("flags", value=cv.flag),
    "cv_whole_or": _query("numbers", value=cv.whole_or, none=lambda c: cv.whole_or(c, None)),
    "cv_number_or": _query("numbers", value=cv.number_or),
    "cv_flag_or": _query("flags", value=cv.flag_or),
    "cv_worded_text": _query("words", value=lambda c: cv.worded_text(c, 8)),
    "cv_tx_values": _query("numbers", number=cv.tx_number, whole=cv.tx_whole, float=cv.tx_float),
    "cv_tx_flag": _query("flags", value=cv.tx_flag),
    "cv_text": _query("words", value=lambda c: cv.text(c, 8)),
    "cv_text_or": _query("words", value=lambda c: cv.text_or(c, "Unknown", 255)),
    "cv_rental_values": _query("numbers", whole=cv.whole, number=cv.number, text=cv.as_is),
    "cv_rental_stamp": _query("dates", day=cv.rental_day, stamp=cv.rental_stamp,
                              minutes=lambda c: cv.rental_stamp(c, minutes=True)),
    "cv_yes_no": _query("flags", value=cv.yes_no),
    "cv_boat_number": _query("boats", value=cv.boat_number),
    "cv_slash_text": _query("dates", text=lambda c: cv.slash_text(cv.trimmed_stamp(c)),
                            value=lambda c: cv.from_slash_text(cv.slash_text(cv.trimmed_stamp(c)))),
    "cv_loaded": _query("numbers", whole=lambda c: cv.loaded(c, "decimal(10,0)").cast("bigint"),
                        money=lambda c: cv.loaded(c, "decimal(9,2)").cast("double")),
}

_trimmed = f"case when not {_NULLISH} then {_strp('trim(raw)', *_STAMP)} end"
ORACLE = {
    "cv_stamp": _oracle("dates", value=_strp("raw", *_STAMP)),
    "cv_day": _oracle("dates", value=f"cast({_strp('raw', *_DATE)} as date)"),
    "cv_person_stamp": _oracle("dates", value=f"case when not {_NULLISH} then {_strp('trim(raw)', *_PERSON_STAMP)} end"),
    "cv_person_day": _oracle("dates", value=f"cast(case when not {_NULLISH} then {_strp('trim(raw)', *_PERSON_DATE)} end as date)"),
    "cv_iso_stamp": _oracle(
        "dates", value=f"case when not {_NULLISH} then {_strp('trim(raw)', *_ISO_STAMP)} end",
        short_words=_strp("trim(raw)", *_ISO_STAMP)),
    "cv_trimmed_stamp": _oracle("dates", value=_trimmed),
    "cv_number_or_zero": _oracle("numbers", value=f"coalesce({_num}, 0.0)"),
    "cv_whole": _oracle("numbers", value=_int),
    "cv_flag": _oracle("flags", value="case when upper(trim(raw)) in ('TRUE', 'T', '1', 'YES', 'Y') then 1 "
                                      "when upper(trim(raw)) in ('FALSE', 'F', '0', 'NO', 'N') then 0 end"),
    "cv_whole_or": _oracle(
        "numbers",
        value=f"coalesce({_int}, case when contains(raw, '.') and {_NUM.format('raw')} and cast(trim(raw) as double) = floor(cast(trim(raw) as double)) then cast(trim(raw) as double)::bigint end, 0)",
        none=f"coalesce({_int}, case when contains(raw, '.') and {_NUM.format('raw')} and cast(trim(raw) as double) = floor(cast(trim(raw) as double)) then cast(trim(raw) as double)::bigint end)"),
    "cv_number_or": _oracle("numbers", value=f"coalesce({_num}, 0.0)"),
    "cv_flag_or": _oracle("flags", value=f"case when upper(trim(raw)) in {_true} then 1 else 0 end"),
    "cv_worded_text": _oracle("words", value=f"case when not {_NULLISH} then nullif(left(trim(raw), 8), '') end"),
    "cv_tx_values": _oracle(
        "numbers",
        number=f"case when contains(raw, '.') or {_INT.format('raw')} then {_num} end",
        whole=f"cast(trunc({_num}) as bigint)", float=_num),
    "cv_tx_flag": _oracle(
        "flags",
        value=f"case when {_NULLISH_ANY} then 0 when upper(trim(raw)) in {_true} then 1 when upper(trim(raw)) in {_false} then 0 "
              f"else coalesce(cast(trunc({_num}) as integer), 0) end"),
    "cv_text": _oracle("words", value="nullif(left(trim(raw), 8), '')"),
    "cv_text_or": _oracle("words", value=f"case when {_NULLISH} then 'Unknown' else left(trim(raw), 255) end"),
    "cv_rental_values": _oracle("numbers", whole=_int, number=_num, text="nullif(raw, '')"),
    "cv_rental_stamp": _oracle("dates", day=f"cast({_strp('raw', 'Y-m-d')} as date)", stamp=_strp("raw", "Y-m-d H:M:S"),
                               minutes=_strp("raw", "Y-m-d H:M:S", "Y-m-d H:M")),
    "cv_yes_no": _oracle("flags", value="case when raw = '1' then 'Yes' else 'No' end"),
    "cv_boat_number": _oracle(
        "boats",
        value="coalesce(case when regexp_full_match(regexp_replace(raw, '[^0-9_]', '', 'g'), '[0-9]+(_[0-9]+)*') "
              "then cast(replace(regexp_replace(raw, '[^0-9_]', '', 'g'), '_', '') as bigint) end, 0)"),
    "cv_slash_text": _oracle("dates", text=f"strftime({_trimmed}, '%d/%m/%Y %H:%M:%S')", value=_trimmed),
    "cv_loaded": _oracle(
        "numbers",
        whole=f"cast(case when {_NUM.format('raw')} then cast(cast(trim(raw) as double) as decimal(28,10)) end as decimal(10,0))::bigint",
        money=f"cast(cast(case when {_NUM.format('raw')} then cast(cast(trim(raw) as double) as decimal(28,10)) end as decimal(9,2)) as double)"),
}
