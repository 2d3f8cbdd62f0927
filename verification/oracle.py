"""The queries again as DuckDB SQL, written on their own over the same tables.

Only the ledger cells (the test input) share their definition with the Spark side.
"""

from __future__ import annotations

from payments_lake.functions.text import MISSING_TOKENS
from payments_lake.operators.dimensions import SPECIAL_VALUES
from payments_lake.schema import (
    AMOUNTS,
    AS_OF,
    BUSINESS_KEY,
    CONTRACT_NUMBER,
    CRITICAL,
    CRITICAL_FOR_TYPES,
    DEPARTMENT,
    DIMENSIONS,
    FILLED_CODES,
    FILLED_DIMENSIONS,
    FISCAL_YEAR,
    FLAGS,
    KEY_CANDIDATES,
    LARGE_AMOUNTS,
    LOADED_AT,
    PO_DATE,
    PURCHASE_ORDER,
    RAW_COLUMNS,
    RAW_TO_SILVER,
    REQUIRED_SILVER_COLUMNS,
    SILVER_COLUMNS,
    SUPPLIER,
    WARNING,
)
from payments_lake.sources.bridge import CENTS, COPIES, EXPRESSIONS, ROW_IDENTITY


def _duck(sql: str) -> str:
    return sql.replace(" as string)", " as varchar)")


def q(name: str) -> str:
    return f'"{name}"'


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


TOKENS = ", ".join(text(t) for t in MISSING_TOKENS)


def nullified(c: str) -> str:
    return f"case when {c} not in ({TOKENS}) then {c} end"


def number(c: str) -> str:
    return (
        f"case when regexp_full_match({c}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') "
        f"then try_cast({c} as double) end"
    )


def money(c: str) -> str:
    plain = f"replace(replace(trim({c}), ',', ''), '$', '')"
    return number(f"regexp_replace({plain}, '^\\((.*)\\)$', '-\\1')")


def moment(c: str) -> str:
    return f"try_strptime({c}, '%Y/%m/%d %I:%M:%S %p')"


def day(c: str) -> str:
    return f"cast(try_strptime({c}, '%Y/%m/%d') as date)"


def year_number(c: str) -> str:
    return number(f"trim({c})")


def key(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce(trim({q(c)}), '<NULL>')" for c in columns)
    return f"concat_ws('||', {parts})"


def contract(c: str) -> str:
    return (
        f"case when trim({c}) not in ('nan', 'NaN', '<NA>') "
        f"then regexp_replace(trim({c}), '\\.0$', '') end"
    )


def pct(part: str, whole: str) -> str:
    return f"case when {whole} > 0 then round({part} * 100.0::double / {whole}, 4) else 0.0 end"


def pct_text(part: str, whole: str) -> str:
    return f"cast(cast({pct(part, whole)} as decimal(9,4)) as varchar)"


def money_text(c: str) -> str:
    return f"cast(cast({c} as decimal(38,2)) as varchar)"


def total(c: str) -> str:
    return f"cast(coalesce(sum(cast({c} as decimal(24,6))), 0) as double)"


_BASE = f"""base as (
  select * from lineitem
  join (values (1), (2), (3)) as copies(copy) on copy <= {COPIES}
  join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  join part on l_partkey = p_partkey
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey)"""

_CENTS = "cents as (select *, " + ", ".join(
    f"{_duck(sql)} as {name}" for name, sql in CENTS.items()
) + " from base)"

_CELLS = "cells as (select " + ", ".join(
    f"{_duck(sql)} as {q(name)}" for name, sql in EXPRESSIONS.items()
) + f", {_duck(ROW_IDENTITY)} as _row_id from cents)"

_RAW = (
    "raw as (select "
    + ", ".join(f"{nullified(q(c))} as {q(c)}" for c in RAW_COLUMNS)
    + ", _row_id from cells)"
)

_HASHED = f"hashed as (select *, md5({key(RAW_COLUMNS)}) as source_row_hash from raw)"


def _clean(c: str) -> str:
    col = q(c)
    if c == FISCAL_YEAR:
        return (
            f"case when {year_number(col)} = floor({year_number(col)}) "
            f"then try_cast({year_number(col)} as integer) end"
        )
    if c in AMOUNTS:
        return money(col)
    if c in (AS_OF, LOADED_AT):
        return moment(col)
    if c == PO_DATE:
        return day(col)
    if c == CONTRACT_NUMBER:
        return contract(col)
    if c in FILLED_DIMENSIONS or c in FILLED_CODES:
        return f"coalesce(trim({col}), 'Unknown')"
    if c in DIMENSIONS:
        return f"trim({col})"
    return col


_TYPED = (
    "typed as (select "
    + ", ".join(f"{_clean(c)} as {silver}" for c, silver in RAW_TO_SILVER.items())
    + f", source_row_hash, {key(BUSINESS_KEY)} as business_composite_key"
    + f", lower(coalesce(trim({q(DEPARTMENT)}), 'Unknown')) as department_norm"
    + f", lower(trim({q(SUPPLIER)})) as supplier_name_norm"
    + ", lower(coalesce(trim(\"Fund Category\"), 'Unknown')) as fund_category_norm"
    + f", {q(DEPARTMENT)} is null as raw_department_missing from hashed)"
)

_SILVER = (
    "silver as (select *, department is null as is_missing_department, "
    "purchase_order_date is null as is_missing_purchase_order_date, "
    "vouchers_paid < 0 as is_negative_paid, "
    + ", ".join(
        f"abs(vouchers_paid) > {int(limit)} as is_large_paid_{size}"
        for size, limit in LARGE_AMOUNTS.items()
    )
    + ", cast(year(purchase_order_date) as integer) as po_year"
    + ", strftime(purchase_order_date, '%Y-%m') as po_month"
    + ", purchase_order_date is not null and fiscal_year <> year(purchase_order_date)"
    + " as is_fiscal_year_mismatch"
    + ", upper(coalesce(non_profit_indicator, '')) = 'X' as is_non_profit from typed)"
)

# Silver as a reader of the stored table sees its text.
_STORED = (
    "stored as (select * replace ("
    + ", ".join(
        f"{nullified(c)} as {c}"
        for c in SILVER_COLUMNS
        if c
        in (
            "organization_group", "department", "fund_type", "fund_category", "supplier_name",
            "purchasing_authority_description", "department_norm", "supplier_name_norm",
            "purchase_order", "business_composite_key", "po_month",
        )
    )
    + ") from silver)"
)

_CHAIN = [_BASE, _CENTS, _CELLS, _RAW, _HASHED, _TYPED, _SILVER, _STORED]
_LEVEL = {"cells": 3, "raw": 4, "hashed": 5, "typed": 6, "silver": 7, "stored": 8}


def over(level: str, select: str, *ctes: str) -> str:
    return "with " + ",\n".join([*_CHAIN[: _LEVEL[level]], *ctes]) + "\n" + select


_SHOWN = {
    "data_as_of": "cast(data_as_of as varchar) as data_as_of",
    "data_loaded_at": "cast(data_loaded_at as varchar) as data_loaded_at",
    "purchase_order_date": "cast(purchase_order_date as varchar) as purchase_order_date",
}


def shown(columns: list[str]) -> str:
    return ", ".join(_SHOWN.get(c, c) for c in columns)


def renamed(columns: list[str] = RAW_COLUMNS) -> str:
    return ", ".join(f"{q(c)} as {RAW_TO_SILVER[c]}" for c in columns)


def union(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


def report(check: str, column: str, metric: str, value: str, source: str) -> str:
    return (
        f"select {text(check)} as \"check\", {text(column)} as column_name, "
        f"{text(metric)} as metric, cast({value} as varchar) as value from {source}"
    )


ORACLE: dict[str, str] = {}

# --- scalar functions -------------------------------------------------------------------------

ORACLE["clean_numeric"] = over(
    "raw",
    "select _row_id, "
    + ", ".join(f"{money(q(c))} as {RAW_TO_SILVER[c]}" for c in AMOUNTS)
    + " from raw",
)
ORACLE["parse_timestamp"] = over(
    "raw",
    "select _row_id, "
    + ", ".join(f"cast({moment(c)} as varchar) as {c}" for c in (AS_OF, LOADED_AT))
    + " from raw",
)
ORACLE["parse_date"] = over(
    "raw", f"select _row_id, cast({day(q(PO_DATE))} as varchar) as purchase_order_date from raw"
)
ORACLE["fiscal_year"] = over(
    "raw", f"select _row_id, {_clean(FISCAL_YEAR)} as fiscal_year from raw"
)
ORACLE["clean_text"] = over(
    "raw",
    "select _row_id, "
    + ", ".join(f"trim({q(c)}) as {RAW_TO_SILVER[c]}" for c in DIMENSIONS)
    + ", "
    + ", ".join(f"coalesce(trim({q(c)}), 'Unknown') as {RAW_TO_SILVER[c]}" for c in FILLED_CODES)
    + " from raw",
)
ORACLE["normalize_text"] = over(
    "raw",
    "select _row_id, "
    + ", ".join(
        f"lower(coalesce(trim({q(c)}), 'Unknown')) as {RAW_TO_SILVER[c]}" for c in DIMENSIONS
    )
    + " from raw",
)
ORACLE["clean_contract_number"] = over(
    "raw", f"select _row_id, {contract(q(CONTRACT_NUMBER))} as contract_number from raw"
)
ORACLE["nullify_tokens"] = over("raw", f"select {renamed()}, _row_id from raw")
ORACLE["business_composite_key"] = over(
    "raw", f"select _row_id, {key(BUSINESS_KEY)} as business_composite_key from raw"
)
ORACLE["source_row_hash"] = over("hashed", "select _row_id, source_row_hash from hashed")
ORACLE["po_year_month"] = over(
    "raw",
    f"select _row_id, cast(year({day(q(PO_DATE))}) as integer) as po_year, "
    f"strftime({day(q(PO_DATE))}, '%Y-%m') as po_month from raw",
)
ORACLE["quality_flags"] = over(
    "silver", f"select source_row_hash, {', '.join(FLAGS)}, po_year, po_month from silver"
)
ORACLE["silver_projection"] = over("typed", f"select {shown(SILVER_COLUMNS[:38])} from typed")
ORACLE["silver_transform"] = over("silver", f"select {shown(SILVER_COLUMNS)} from silver")
ORACLE["silver_flags_from_raw"] = over(
    "silver",
    "select source_row_hash, raw_department_missing as is_missing_department, "
    f"{', '.join(FLAGS[1:])} from silver",
)

# --- gold -------------------------------------------------------------------------------------

_METRICS = f"""{total('vouchers_paid')} as total_vouchers_paid,
  {total('vouchers_pending')} as total_vouchers_pending,
  {total('encumbrance_balance')} as total_encumbrance_balance,
  {total('vouchers_pending_retainage')} as total_pending_retainage,
  count(source_row_hash) as record_count,
  count(distinct supplier_name) as unique_suppliers,
  count(*) filter (where is_negative_paid) as negative_paid_records,
  count(*) filter (where is_large_paid_1m) as large_paid_1m_records,
  count(*) filter (where is_missing_purchase_order_date) as missing_po_date_records"""

_MART_TOTALS = [
    "total_vouchers_paid",
    "total_vouchers_pending",
    "total_encumbrance_balance",
    "total_pending_retainage",
]
_MART_COUNTS = [
    "record_count",
    "unique_suppliers",
    "negative_paid_records",
    "large_paid_1m_records",
    "missing_po_date_records",
]
_MART_BODIES = {
    "mart_spending_by_fiscal_year": (["fiscal_year"], ""),
    "mart_spending_by_department": (["fiscal_year", "organization_group", "department"], ""),
    "mart_spending_by_supplier_top_n": (
        ["supplier_name"],
        " order by total_vouchers_paid desc nulls last, supplier_name nulls last limit 100",
    ),
    "mart_pending_by_department": (
        ["fiscal_year", "department"],
        " having sum(cast(vouchers_pending as decimal(24,6))) <> 0",
    ),
    "mart_fund_category_summary": (["fiscal_year", "fund_type", "fund_category"], ""),
}


def mart(keys: list[str], tail: str) -> str:
    names = ", ".join(keys)
    return f"select {names}, {_METRICS} from stored group by {names}{tail}"


def rounded_mart(keys: list[str], tail: str) -> str:
    return (
        f"select {', '.join(keys)}, "
        + ", ".join(f"round({c}, 2) as {c}" for c in _MART_TOTALS)
        + f", {', '.join(_MART_COUNTS)} from ({mart(keys, tail)})"
    )


for _name, (_keys, _tail) in _MART_BODIES.items():
    ORACLE[_name] = over("stored", rounded_mart(_keys, _tail))
ORACLE["group_metrics"] = over(
    "stored", rounded_mart(["fiscal_year", "purchasing_authority_description"], "")
)
_MART_CTES = [f"{name} as ({mart(keys, tail)})" for name, (keys, tail) in _MART_BODIES.items()]
ORACLE["gold_marts_from_sketches"] = over(
    "stored",
    union(
        [
            f"select '{name}' as mart, count(*) as row_count, "
            f"round({total('total_vouchers_paid')}, 2) as paid, "
            f"cast(sum(record_count) as bigint) as records, true as near from {name}"
            for name in _MART_BODIES
        ]
    ),
    *_MART_CTES,
)
ORACLE["gold_marts_from_base"] = over(
    "stored",
    union(
        [
            f"select '{name}' as mart, count(*) as row_count, "
            f"round({total('total_vouchers_paid')}, 2) as paid, "
            "cast(sum(record_count) as bigint) as records, "
            "cast(sum(unique_suppliers) as bigint) as suppliers, "
            f"cast(sum(missing_po_date_records) as bigint) as missing_po_dates from {name}"
            for name in _MART_BODIES
        ]
    ),
    *_MART_CTES,
)

# --- missing values and types -----------------------------------------------------------------


def any_null(columns: list[str]) -> str:
    return "(" + " or ".join(f"{q(c)} is null" for c in columns) + ")"


def missing_rows(columns: list[str]) -> str:
    hit = f"count(*) filter (where {any_null(columns)})"
    return (
        f"select count(*) as total_rows, {hit} as missing_rows, "
        f"{pct(hit, 'count(*)')} as missing_pct from raw"
    )


def nulls(c: str) -> str:
    return f"count(*) filter (where {c} is null)"


ORACLE["null_counts"] = over(
    "raw",
    union(
        [
            f"select {text(c)} as column_name, {nulls(q(c))} as null_count, "
            f"count(*) as total_rows, {pct(nulls(q(c)), 'count(*)')} as null_pct from raw"
            for c in RAW_COLUMNS
        ]
    ),
)
ORACLE["critical_missing_rows"] = over("raw", missing_rows(CRITICAL))
ORACLE["warning_missing_rows"] = over("raw", missing_rows(WARNING))
_WARNING_EXAMPLE = [FISCAL_YEAR, PURCHASE_ORDER, DEPARTMENT, PO_DATE, "Encumbrance Balance"]
ORACLE["critical_examples"] = over(
    "raw",
    f"select _row_id as row_id, {renamed(CRITICAL)} from raw where {any_null(CRITICAL)} "
    "order by _row_id limit 10",
)
ORACLE["missing_examples"] = over(
    "raw",
    f"select _row_id as row_id, {renamed(_WARNING_EXAMPLE)} from raw "
    f"where {any_null(WARNING)} order by _row_id limit 10",
)

_PARSERS = {
    **{c: money(q(c)) for c in AMOUNTS},
    AS_OF: moment(AS_OF),
    LOADED_AT: moment(LOADED_AT),
    PO_DATE: day(q(PO_DATE)),
    FISCAL_YEAR: year_number(q(FISCAL_YEAR)),
}


def parsed_text(c: str, value: str) -> str:
    if c in AMOUNTS:
        return money_text(value)
    if c == FISCAL_YEAR:
        return f"cast(cast({value} as bigint) as varchar)"
    return f"cast({value} as varchar)"


def invalid(c: str) -> str:
    return f"count(*) filter (where {q(c)} is not null and ({_PARSERS[c]}) is null)"


ORACLE["parse_failures"] = over(
    "raw",
    union(
        [
            f"select {text(c)} as column_name, {nulls(q(c))} as null_count, "
            f"{invalid(c)} as invalid_count from raw"
            for c in _PARSERS
        ]
    ),
)
ORACLE["column_ranges"] = over(
    "raw",
    union(
        [
            f"select {text(c)} as column_name, {parsed_text(c, f'min({p})')} as min_value, "
            f"{parsed_text(c, f'max({p})')} as max_value from raw"
            for c, p in _PARSERS.items()
        ]
    ),
)

_rows = [report("missing_values", "", "total_rows", "count(*)", "raw")]
for _c in RAW_COLUMNS:
    _rows.append(report("missing_values", _c, "null_count", nulls(q(_c)), "raw"))
    _rows.append(
        report("missing_values", _c, "null_pct", pct_text(nulls(q(_c)), "count(*)"), "raw")
    )
for _level, _columns in (("critical", CRITICAL), ("warning", WARNING)):
    _hit = f"count(*) filter (where {any_null(_columns)})"
    _rows.append(report("missing_values", "", f"{_level}_rows", _hit, "raw"))
    _rows.append(
        report("missing_values", "", f"{_level}_pct", pct_text(_hit, "count(*)"), "raw")
    )
ORACLE["profile_missing"] = over("raw", union(_rows))

_rows = [report("data_types", "", "total_rows", "count(*)", "raw")]
for _c, _p in _PARSERS.items():
    _rows += [
        report("data_types", _c, "null_count", nulls(q(_c)), "raw"),
        report("data_types", _c, "invalid_count", invalid(_c), "raw"),
        report("data_types", _c, "min", parsed_text(_c, f"min({_p})"), "raw"),
        report("data_types", _c, "max", parsed_text(_c, f"max({_p})"), "raw"),
    ]
_rows += [
    report("data_types", CONTRACT_NUMBER, "null_count", nulls(q(CONTRACT_NUMBER)), "raw"),
    report(
        "data_types",
        CONTRACT_NUMBER,
        "float_like_count",
        f"count(*) filter (where {q(CONTRACT_NUMBER)} like '%.0')",
        "raw",
    ),
]
for _c in CRITICAL_FOR_TYPES:
    _rows += [
        report("data_types", _c, "critical_null_count", nulls(q(_c)), "raw"),
        report(
            "data_types", _c, "critical_null_pct", pct_text(nulls(q(_c)), "count(*)"), "raw"
        ),
    ]
ORACLE["profile_data_types"] = over("raw", union(_rows))

# --- business rules ---------------------------------------------------------------------------

_COUNTER_TESTS = {
    "null_count": "v is null",
    "negative_count": "v < 0",
    "zero_count": "v = 0",
    "positive_count": "v > 0",
    **{f"over_{size}_count": f"abs(v) > {int(limit)}" for size, limit in LARGE_AMOUNTS.items()},
}
_AMOUNT_CTES = [
    f"a{i} as (select *, {money(q(c))} as v from raw)" for i, c in enumerate(AMOUNTS)
]
ORACLE["amount_profile"] = over(
    "raw",
    union(
        [
            f"select {text(c)} as column_name, "
            + ", ".join(f"count(*) filter (where {t}) as {n}" for n, t in _COUNTER_TESTS.items())
            + f" from a{i}"
            for i, c in enumerate(AMOUNTS)
        ]
    ),
    *_AMOUNT_CTES,
)
_EXTREME_FIELDS = {
    "fiscal_year": FISCAL_YEAR,
    "department": DEPARTMENT,
    "purchase_order": PURCHASE_ORDER,
    "supplier": SUPPLIER,
    "contract_number": CONTRACT_NUMBER,
}


def extreme(i: int, direction: str) -> str:
    fields = ", ".join(f"{q(c)} as {n}" for n, c in _EXTREME_FIELDS.items())
    order = "v" if direction == "min" else "v desc"
    return (
        f"(select v as value, {fields} from a{i} where v is not null "
        f"order by {order}, _row_id limit 1)"
    )


ORACLE["amount_extremes"] = over(
    "raw",
    union(
        [
            f"select {text(c)} as column_name, '{d}' as extreme, * from {extreme(i, d)}"
            for i, c in enumerate(AMOUNTS)
            for d in ("min", "max")
        ]
    ),
    *_AMOUNT_CTES,
)


def later_than(c: str) -> str:
    return f"{day(q(PO_DATE))} > {moment(c)}"


_YEAR_DIFFERS = f"year({day(q(PO_DATE))}) <> {year_number(q(FISCAL_YEAR))}"
_RULES = {
    "po_date_after_data_as_of": later_than(AS_OF),
    "po_date_after_data_loaded_at": later_than(LOADED_AT),
}
ORACLE["date_order_violations"] = over(
    "raw",
    union(
        [
            f"select '{rule}' as rule, count(*) filter (where {t}) as violations, "
            f"{pct(f'count(*) filter (where {t})', 'count(*)')} as violation_pct from raw"
            for rule, t in _RULES.items()
        ]
    ),
)
_hit = f"count(*) filter (where {_YEAR_DIFFERS})"
ORACLE["fiscal_year_mismatch"] = over(
    "raw",
    f"select count(*) as total_rows, {_hit} as mismatches, "
    f"{pct(_hit, 'count(*)')} as mismatch_pct from raw",
)
_YEAR_TEXT = f"cast(cast({year_number(q(FISCAL_YEAR))} as bigint) as varchar)"
ORACLE["fiscal_year_distribution"] = over(
    "raw",
    f"select {_YEAR_TEXT} as fiscal_year, count(*) as records, "
    f"{pct('count(*)', '(select count(*) from raw)')} as pct from raw group by 1",
)
_EXAMPLE_COLUMNS = {
    "date_order": (
        f"coalesce({later_than(AS_OF)}, false) or coalesce({later_than(LOADED_AT)}, false)",
        [FISCAL_YEAR, PURCHASE_ORDER, DEPARTMENT, PO_DATE, AS_OF, LOADED_AT],
    ),
    "fiscal_year_mismatch": (
        _YEAR_DIFFERS,
        [FISCAL_YEAR, PURCHASE_ORDER, DEPARTMENT, PO_DATE, AS_OF],
    ),
    "warning_missing": (any_null(WARNING), _WARNING_EXAMPLE),
}
ORACLE["violation_examples"] = over(
    "raw",
    union(
        [
            f"select '{rule}' as rule, * from (select _row_id as row_id, "
            + ", ".join(
                f"{q(c) if c in columns else 'null::varchar'} as {RAW_TO_SILVER[c]}"
                for c in [
                    FISCAL_YEAR,
                    PURCHASE_ORDER,
                    DEPARTMENT,
                    PO_DATE,
                    AS_OF,
                    LOADED_AT,
                    "Encumbrance Balance",
                ]
            )
            + f" from raw where {condition} order by _row_id limit 10)"
            for rule, (condition, columns) in _EXAMPLE_COLUMNS.items()
        ]
    ),
)
_rows = [report("business_rules", "", "total_rows", "count(*)", "raw")]
for _i, _c in enumerate(AMOUNTS):
    for _n, _t in _COUNTER_TESTS.items():
        _rows.append(
            report("business_rules", _c, _n, f"count(*) filter (where {_t})", f"a{_i}")
        )
    for _d in ("min", "max"):
        _source = extreme(_i, _d)
        _rows.append(
            report("business_rules", _c, f"{_d}_value", money_text("value"), _source)
        )
        for _field in _EXTREME_FIELDS:
            _rows.append(report("business_rules", _c, f"{_d}_{_field}", _field, _source))
for _rule, _t in {**_RULES, "fiscal_year_mismatch": _YEAR_DIFFERS}.items():
    _hit = f"count(*) filter (where {_t})"
    _rows.append(report("business_rules", "", _rule, _hit, "raw"))
    _rows.append(report("business_rules", "", f"{_rule}_pct", pct_text(_hit, "count(*)"), "raw"))
_rows.append(
    f"select 'business_rules' as \"check\", coalesce({_YEAR_TEXT}, '<NULL>') as column_name, "
    "'fiscal_year_records' as metric, cast(count(*) as varchar) as value from raw group by 2"
)
ORACLE["profile_business_rules"] = over("raw", union(_rows), *_AMOUNT_CTES)

# --- keys -------------------------------------------------------------------------------------

_KEYS = "key_counts as (" + union(
    [
        f"select '{name}' as key_name, {key(columns)} as key, count(*) as n from raw group by 2"
        for name, columns in KEY_CANDIDATES.items()
    ]
) + ")"
_ROWS = "row_counts as (select source_row_hash as key, count(*) as n from hashed group by 1)"
_UNIQUENESS = f"""cast(sum(n) as bigint) as total_rows, count(*) as unique_key_count,
  {pct('count(*)', 'sum(n)')} as uniqueness_pct,
  count(*) filter (where n > 1) as duplicate_key_count,
  cast(sum(n - 1) as bigint) as duplicate_rows_beyond_first,
  {pct('sum(n - 1)', 'sum(n)')} as duplicate_rows_pct, max(n) as max_records_per_key"""
ORACLE["key_profile"] = over(
    "raw", f"select key_name, {_UNIQUENESS} from key_counts group by key_name", _KEYS
)
ORACLE["full_row_duplicates"] = over("hashed", f"select {_UNIQUENESS} from row_counts", _ROWS)
_TOP_KEYS = (
    "top_keys as (select * from (select key_name, key, n, row_number() over "
    "(partition by key_name order by n desc, key) as rank from key_counts where n > 1) "
    "where rank <= 10)"
)
ORACLE["top_duplicate_keys"] = over(
    "raw",
    "select key_name, cast(rank as integer) as rank, left(key, 300) as key, n as records "
    "from top_keys",
    _KEYS,
    _TOP_KEYS,
)
_DIRECT = f"count(*) filter (where trim({q(PURCHASE_ORDER)}) = 'Direct Payments')"
ORACLE["direct_payment_share"] = over(
    "raw",
    f"select count(*) as total_rows, {nulls(q(PURCHASE_ORDER))} as purchase_order_nulls, "
    f"{_DIRECT} as direct_payments, {pct(_DIRECT, 'count(*)')} as direct_payments_pct from raw",
)
_NUMBERS = {
    "unique_key_count": "unique_key_count",
    "uniqueness_pct": "cast(cast(uniqueness_pct as decimal(9,4)) as varchar)",
    "duplicate_key_count": "duplicate_key_count",
    "duplicate_rows_beyond_first": "duplicate_rows_beyond_first",
    "duplicate_rows_pct": "cast(cast(duplicate_rows_pct as decimal(9,4)) as varchar)",
    "max_records_per_key": "max_records_per_key",
}


def subject_report(check: str, column: str, values: dict[str, str], source: str) -> list[str]:
    return [
        f"select '{check}' as \"check\", {column} as column_name, '{metric}' as metric, "
        f"cast({value} as varchar) as value from {source}"
        for metric, value in values.items()
    ]


ORACLE["profile_duplicates"] = over(
    "hashed",
    union(
        [
            report("duplicates", "", "total_rows", "count(*)", "raw"),
            report("duplicates", PURCHASE_ORDER, "null_count", nulls(q(PURCHASE_ORDER)), "raw"),
            report("duplicates", PURCHASE_ORDER, "direct_payments", _DIRECT, "raw"),
            report(
                "duplicates",
                PURCHASE_ORDER,
                "direct_payments_pct",
                pct_text(_DIRECT, "count(*)"),
                "raw",
            ),
            *subject_report("duplicates", "key_name", _NUMBERS, "key_numbers"),
            *subject_report(
                "duplicates",
                "key_name",
                {
                    "top_duplicate_key": "concat(lpad(cast(rank as varchar), 2, '0'), '|', "
                    "left(key, 300), '|', n)"
                },
                "top_keys",
            ),
            *subject_report("duplicates", "'full_row'", _NUMBERS, "row_numbers"),
        ]
    ),
    _KEYS,
    _TOP_KEYS,
    _ROWS,
    f"key_numbers as (select key_name, {_UNIQUENESS} from key_counts group by key_name)",
    f"row_numbers as (select {_UNIQUENESS} from row_counts)",
)

# --- dimensions -------------------------------------------------------------------------------

_DIMS = "dims as (" + union(
    [f"select {text(c)} as dimension, {q(c)} as v from raw" for c in DIMENSIONS]
) + ")"
_DIM_FORMS = (
    "forms as (select dimension, v is null as missing, coalesce(v, '<NULL>') as raw_text, "
    "coalesce(trim(v), '<NULL>') as stripped from dims)"
)
_CARDINALITY = f"""cardinality as (select dimension, count(*) as total_rows,
  count(distinct raw_text) as raw_unique_count,
  count(distinct stripped) as stripped_unique_count,
  count(distinct lower(stripped)) as lower_unique_count,
  count(*) filter (where missing) as null_count,
  {pct('count(*) filter (where missing)', 'count(*)')} as null_pct,
  count(*) filter (where raw_text <> stripped) as whitespace_issue_count,
  {pct('count(*) filter (where raw_text <> stripped)', 'count(*)')} as whitespace_issue_pct
  from forms group by dimension)"""
ORACLE["dimension_cardinality"] = over(
    "raw",
    "select *, raw_unique_count <> stripped_unique_count as stripping_merges, "
    "stripped_unique_count <> lower_unique_count as lowering_merges from cardinality",
    _DIMS,
    _DIM_FORMS,
    _CARDINALITY,
)
_DIM_VALUES = (
    "dim_values as (select dimension, stripped as value, count(*) as records, "
    f"{pct('count(*)', '(select count(*) from raw)')} as pct from forms group by 1, 2)"
)
_DIM_TOP = (
    "dim_top as (select * from (select *, cast(row_number() over (partition by dimension "
    "order by records desc, value) as integer) as rank from dim_values) where rank <= 15)"
)
_SPECIAL = f"value in ({', '.join(text(v) for v in SPECIAL_VALUES)})"
ORACLE["dimension_top_values"] = over(
    "raw", "select dimension, rank, value, records, pct from dim_top",
    _DIMS, _DIM_FORMS, _DIM_VALUES, _DIM_TOP,
)
ORACLE["special_values"] = over(
    "raw", f"select * from dim_values where {_SPECIAL}", _DIMS, _DIM_FORMS, _DIM_VALUES
)
_SHARE_TEXT = "cast(cast(pct as decimal(9,4)) as varchar)"
ORACLE["profile_dimensions"] = over(
    "raw",
    union(
        [
            *subject_report(
                "dimensions",
                "dimension",
                {
                    "raw_unique_count": "raw_unique_count",
                    "stripped_unique_count": "stripped_unique_count",
                    "lower_unique_count": "lower_unique_count",
                    "null_count": "null_count",
                    "null_pct": "cast(null_pct as decimal(9,4))",
                    "whitespace_issue_count": "whitespace_issue_count",
                    "whitespace_issue_pct": "cast(whitespace_issue_pct as decimal(9,4))",
                    "note": "concat_ws('; ', case when raw_unique_count <> stripped_unique_count"
                    " then 'stripping white space merges values' end,"
                    " case when stripped_unique_count <> lower_unique_count"
                    " then 'lower case merges values' end)",
                },
                "cardinality",
            ),
            *subject_report(
                "dimensions",
                "dimension",
                {"special_value": f"concat_ws('|', value, records, {_SHARE_TEXT})"},
                f"(select * from dim_values where {_SPECIAL})",
            ),
            *subject_report(
                "dimensions",
                "dimension",
                {
                    "top_value": "concat_ws('|', lpad(cast(rank as varchar), 2, '0'), value, "
                    f"records, {_SHARE_TEXT})"
                },
                "dim_top",
            ),
        ]
    ),
    _DIMS, _DIM_FORMS, _CARDINALITY, _DIM_VALUES, _DIM_TOP,
)

# --- time -------------------------------------------------------------------------------------

_TIMES = (
    f"times as (select *, {moment(AS_OF)} as as_of, {moment(LOADED_AT)} as loaded, "
    f"{day(q(PO_DATE))} as po, {year_number(q(FISCAL_YEAR))} as fy from raw)"
)
_TIME_FIELDS = {AS_OF: "as_of", LOADED_AT: "loaded", PO_DATE: "po"}
_RANGES = {
    FISCAL_YEAR: ("cast(cast(min(fy) as bigint) as varchar)", "cast(cast(max(fy) as bigint) as varchar)"),
    **{
        c: (f"cast(min({t}) as varchar)", f"cast(max({t}) as varchar)")
        for c, t in _TIME_FIELDS.items()
    },
}
ORACLE["time_ranges"] = over(
    "raw",
    union(
        [
            f"select {text(c)} as column_name, {low} as min_value, {high} as max_value from times"
            for c, (low, high) in _RANGES.items()
        ]
    ),
    _TIMES,
)
ORACLE["date_quality"] = over(
    "raw",
    union(
        [
            f"select {text(c)} as column_name, {nulls(q(c))} as null_count, "
            f"count({q(c)}) - count({t}) as invalid_count, count({t}) as valid_count, "
            f"{pct(f'count({t})', 'count(*)')} as valid_pct from times"
            for c, t in _TIME_FIELDS.items()
        ]
    ),
    _TIMES,
)
_MISMATCH = "count(*) filter (where fy <> year(as_of))"
ORACLE["as_of_year_mismatch"] = over(
    "raw",
    f"select count(*) as total_rows, {_MISMATCH} as mismatches, "
    f"{pct(_MISMATCH, 'count(*)')} as mismatch_pct from times",
    _TIMES,
)
_KINDS = {
    "fiscal_year": ("cast(cast(fy as bigint) as varchar)", "count(*)"),
    "po_year": ("cast(year(po) as varchar)", "count(po)"),
    "po_month": ("strftime(po, '%Y-%m')", "count(po)"),
    "as_of_year": ("cast(year(as_of) as varchar)", "count(*)"),
    "as_of_month": ("strftime(as_of, '%Y-%m')", "count(*)"),
    "loaded_at": ("cast(loaded as varchar)", "count(*)"),
}


def distribution(kind: str, name: str, tail: str = "") -> str:
    value, whole = _KINDS[kind]
    keep = "" if kind == "fiscal_year" else f" where {value} is not null"
    return (
        f"select {value} as {name}, count(*) as records, "
        f"{pct('count(*)', f'(select {whole} from times)')} as pct from times{keep} "
        f"group by 1{tail}"
    )


ORACLE["po_year_distribution"] = over("raw", distribution("po_year", "po_year"), _TIMES)
ORACLE["as_of_year_distribution"] = over("raw", distribution("as_of_year", "as_of_year"), _TIMES)
ORACLE["top_po_months"] = over(
    "raw", distribution("po_month", "po_month", " order by records desc, 1 limit 20"), _TIMES
)
ORACLE["top_as_of_months"] = over(
    "raw", distribution("as_of_month", "as_of_month", " order by records desc, 1 limit 20"), _TIMES
)
ORACLE["freshness"] = over(
    "raw", distribution("loaded_at", "loaded_at", " order by records desc, 1 limit 10"), _TIMES
)
_rows = [report("time_coverage", "", "total_rows", "count(*)", "times")]
for _c, _t in _TIME_FIELDS.items():
    _rows += [
        report("time_coverage", _c, "null_count", nulls(q(_c)), "times"),
        report("time_coverage", _c, "invalid_count", f"count({q(_c)}) - count({_t})", "times"),
        report("time_coverage", _c, "valid_count", f"count({_t})", "times"),
        report("time_coverage", _c, "valid_pct", pct_text(f"count({_t})", "count(*)"), "times"),
    ]
for _c, (_low, _high) in _RANGES.items():
    _rows += [
        report("time_coverage", _c, "min", _low, "times"),
        report("time_coverage", _c, "max", _high, "times"),
    ]
_rows += [
    report("time_coverage", "", "as_of_year_mismatch", _MISMATCH, "times"),
    report(
        "time_coverage", "", "as_of_year_mismatch_pct", pct_text(_MISMATCH, "count(*)"), "times"
    ),
    report("time_coverage", LOADED_AT, "unique_timestamps", "count(distinct loaded)", "times"),
]
_ENTRY = f"concat_ws('|', coalesce(value, '<NULL>'), records, {_SHARE_TEXT})"
for _kind in ("fiscal_year", "po_year", "as_of_year"):
    _rows += subject_report(
        "time_coverage", f"'{_kind}'", {"distribution": _ENTRY}, f"({distribution(_kind, 'value')})"
    )
for _kind, _k in {"po_month": 20, "as_of_month": 20, "loaded_at": 10}.items():
    _rows += subject_report(
        "time_coverage",
        f"'{_kind}'",
        {"top_value": _ENTRY},
        f"({distribution(_kind, 'value', f' order by records desc, 1 limit {_k}')})",
    )
ORACLE["profile_time_coverage"] = over("raw", union(_rows), _TIMES)

# --- validation -------------------------------------------------------------------------------

ORACLE["flag_counts"] = over(
    "silver",
    union(
        [
            f"select '{f}' as flag, count(*) filter (where {f}) as true_count, "
            f"{pct(f'count(*) filter (where {f})', 'count(*)')} as true_pct from silver"
            for f in FLAGS
        ]
    ),
)
_UNIQUE = "count(distinct source_row_hash)"
_rows = [
    report(
        "silver_output",
        "",
        "status",
        f"case when {_UNIQUE} = count(*) then 'PASS' else 'PASS_WITH_WARNINGS' end",
        "silver",
    ),
    report("silver_output", "", "column_count", "any_value(49)", "silver"),
    report("silver_output", "", "missing_required_columns", "any_value('')", "silver"),
    report("silver_output", "source_row_hash", "unique_count", _UNIQUE, "silver"),
    report(
        "silver_output", "source_row_hash", "uniqueness_pct", pct_text(_UNIQUE, "count(*)"), "silver"
    ),
    report("silver_output", "", "total_rows", "count(*)", "silver"),
    report("silver_output", "fiscal_year", "min", "min(fiscal_year)", "silver"),
    report("silver_output", "fiscal_year", "max", "max(fiscal_year)", "silver"),
]
for _c in REQUIRED_SILVER_COLUMNS:
    _rows += [
        report("silver_output", _c, "null_count", nulls(_c), "stored"),
        report("silver_output", _c, "null_pct", pct_text(nulls(_c), "count(*)"), "stored"),
    ]
for _f in FLAGS:
    _hit = f"count(*) filter (where {_f})"
    _rows += [
        report("silver_output", _f, "true_count", _hit, "silver"),
        report("silver_output", _f, "true_pct", pct_text(_hit, "count(*)"), "silver"),
    ]
ORACLE["validate_silver"] = over("stored", union(_rows))
_DROPPED = ["department", "po_month"]
ORACLE["validate_silver_incomplete"] = over(
    "stored",
    "select \"check\", column_name, metric, case metric when 'status' then 'PASS_WITH_WARNINGS' "
    f"when 'column_count' then '{49 - len(_DROPPED)}' when 'missing_required_columns' then "
    f"'{', '.join(c for c in REQUIRED_SILVER_COLUMNS if c in _DROPPED)}' else value end as value "
    f"from ({union(_rows)}) where column_name not in ('{"', '".join(_DROPPED)}')",
)
ORACLE["mart_metric_summary"] = over(
    "stored",
    union(
        [
            f"select '{name}' as mart, '{m}' as metric, {nulls(m)} as null_count, "
            f"round({total(m)}, 2) as metric_sum from {name}"
            for name in _MART_BODIES
            for m in [*_MART_TOTALS, "record_count"]
        ]
    ),
    *_MART_CTES,
)
ORACLE["validate_gold"] = over(
    "stored",
    union(
        [
            f"select '{name}' as mart, true as mart_exists, count(*) as row_count, "
            f"{len(keys) + 9} as column_count, '' as missing_columns, "
            f"case when count(*) = 0 then 'FAIL: no rows' else 'PASS' end as status from {name}"
            for name, (keys, _) in _MART_BODIES.items()
        ]
    ),
    *_MART_CTES,
)

_ABSENT, _EMPTY, _NARROW = list(_MART_BODIES)[:3]


def _failing_mart(name: str, keys: list[str]) -> str:
    exists, rows, columns, lacks, status = "true", "count(*)", len(keys) + 9, "", "PASS"
    if name == _ABSENT:
        exists, rows, columns, status = "false", "0", 0, "FAIL: file does not exist"
    elif name == _EMPTY:
        rows, status = "0", "FAIL: no rows"
    elif name == _NARROW:
        columns, lacks, status = columns - 1, "record_count", "FAIL: missing required columns"
    return (
        f"select '{name}' as mart, {exists} as mart_exists, {rows} as row_count, "
        f"{columns} as column_count, '{lacks}' as missing_columns, '{status}' as status from {name}"
        + (" limit 1" if rows == "0" else "")
    )


ORACLE["validate_gold_failing"] = over(
    "stored",
    " union all ".join(
        f"select * from ({_failing_mart(name, keys)})" for name, (keys, _) in _MART_BODIES.items()
    ),
    *_MART_CTES,
)

# --- record texts -----------------------------------------------------------------------------


def _field(c: str) -> str:
    return f"case when {q(c)} is null then '' else concat('\"', replace({q(c)}, '\"', '\"\"'), '\"') end"


_SHORT, _LONG = f"{q(PO_DATE)} = 'unknown'", "\"Vouchers Pending\" = 'pending'"
_WIDTHS = (
    f"widths as (select _row_id as row_id, case when {_SHORT} then 31 when {_LONG} then 34 "
    "else 33 end as width, "
    f"concat_ws(' | ', {', '.join(_field(c) for c in RAW_COLUMNS[:10])}) as preview from cells)"
)
_BAD = "bad as (select * from widths where width <> 33 order by row_id limit 20)"
ORACLE["row_width_histogram"] = over(
    "cells", "select width as field_count, count(*) as records from widths group by 1", _WIDTHS
)
ORACLE["malformed_records"] = over(
    "cells",
    "select row_id, 33 as expected_columns, width as actual_columns, preview from bad",
    _WIDTHS,
    _BAD,
)
_rows = [
    report("file_structure", "", "total_rows", "count(*)", "widths"),
    report(
        "file_structure", "", "malformed_rows", "count(*) filter (where width <> 33)", "widths"
    ),
    report("file_structure", "", "header_columns", "any_value(33)", "widths"),
]
_rows += [
    report("file_structure", c, "header_position", f"any_value({i})", "widths")
    for i, c in enumerate(RAW_COLUMNS, 1)
]
_rows += [
    "select 'file_structure' as \"check\", cast(width as varchar) as column_name, "
    "'records_of_width' as metric, cast(count(*) as varchar) as value from widths group by width",
    *subject_report(
        "file_structure", "row_id", {"bad_row": "concat_ws('|', 33, width, preview)"}, "bad"
    ),
]
ORACLE["profile_file_structure"] = over("cells", union(_rows), _WIDTHS, _BAD)
_READ_CELLS = ", ".join(
    (
        f"case when {_SHORT} then null else {nullified(q(c))} end as {RAW_TO_SILVER[c]}"
        if c in RAW_COLUMNS[-2:]
        else f"{nullified(q(c))} as {RAW_TO_SILVER[c]}"
    )
    for c in RAW_COLUMNS
)
ORACLE["parse_records"] = over("cells", f"select _row_id as row_id, {_READ_CELLS} from cells")
ORACLE["raw_scan"] = over(
    "cells",
    f"select {_READ_CELLS}, case when {_SHORT} then 31 when {_LONG} then 34 else 33 end as width "
    "from cells",
)
ORACLE["landed_widths"] = ORACLE["row_width_histogram"]

# --- schema -----------------------------------------------------------------------------------

_CELLS_LONG = "long as (" + union(
    [f"select {text(c)} as column_name, {q(c)} as v, _row_id from raw" for c in RAW_COLUMNS]
) + ")"
_TYPE_COUNTS = f"""type_counts as (select column_name, count(*) as total_rows,
  count(v) as non_null_count,
  count(*) filter (where regexp_full_match(v, '\\s*[+-]?\\d+\\s*')) as integer_count,
  count({number('trim(v)')}) as number_count,
  count({day('v')}) as date_count, count({moment('v')}) as timestamp_count,
  count(*) filter (where lower(v) in ('true', 'false')) as boolean_count
  from long group by column_name)"""
_TYPED_COLUMNS = """column_types as (select *, case when non_null_count = 0 then 'double'
  when non_null_count = total_rows and integer_count = non_null_count then 'bigint'
  when number_count = non_null_count then 'double'
  when non_null_count = total_rows and boolean_count = non_null_count then 'boolean'
  else 'string' end as inferred_type from type_counts)"""
_SAMPLES = (
    "samples as (select * from (select column_name, v as value, cast(row_number() over "
    "(partition by column_name order by _row_id) as integer) as position from long "
    "where v is not null) where position <= 5)"
)
ORACLE["type_profile"] = over(
    "raw", "select * from column_types", _CELLS_LONG, _TYPE_COUNTS, _TYPED_COLUMNS
)
ORACLE["sample_values"] = over(
    "raw", "select column_name, position, value from samples", _CELLS_LONG, _SAMPLES
)
_ONE = "(select 1)"
ORACLE["profile_schema"] = over(
    "raw",
    union(
        [
            report("schema", "", "expected_columns", "33", _ONE),
            report("schema", "", "actual_columns", "33", _ONE),
            report("schema", "", "missing_columns", "'None'", _ONE),
            report("schema", "", "extra_columns", "'None'", _ONE),
            report("schema", "", "order_matches", "true", _ONE),
            *[report("schema", c, "position", text(f"OK|{c}"), _ONE) for c in RAW_COLUMNS],
            *subject_report(
                "schema",
                "column_name",
                {"non_null_count": "non_null_count", "inferred_type": "inferred_type"},
                "column_types",
            ),
            *subject_report(
                "schema",
                "column_name",
                {"sample_value": "concat_ws('|', position, value)"},
                "samples",
            ),
        ]
    ),
    _CELLS_LONG,
    _TYPE_COUNTS,
    _TYPED_COLUMNS,
    _SAMPLES,
)

# --- sampling ---------------------------------------------------------------------------------

_SAMPLE_KEY = "md5(concat(_row_id, '|42'))"
_SIMPLE = f"picked as (select * from hashed order by {_SAMPLE_KEY}, source_row_hash limit 1000)"
ORACLE["simple_sample"] = over("hashed", f"select {renamed()} from picked", _SIMPLE)
ORACLE["stratified_sample"] = over(
    "hashed",
    f"select {renamed()} from (select *, row_number() over (partition by "
    f"{year_number(q(FISCAL_YEAR))} order by {_SAMPLE_KEY}) as rank from hashed "
    f"where {year_number(q(FISCAL_YEAR))} is not null) where rank <= 500",
)
ORACLE["silver_stream_sample"] = over(
    "silver",
    f"select {shown(SILVER_COLUMNS)} from (select *, row_number() over (partition by "
    "source_row_hash) as nth from silver) join (select source_row_hash, count(*) as n from picked "
    "group by 1) using (source_row_hash) where nth <= n",  # copies are alike
    _SIMPLE,
)

# --- readiness --------------------------------------------------------------------------------


def hits(condition: str) -> str:
    return f"count(*) filter (where {condition})"


_FINDINGS = "findings as (" + union(
    [
        "select 'file_structure' as \"check\", 0 as failures, "
        "count(*) filter (where width <> 33) as warnings from widths",
        "select 'schema', 0, 0",
        "select 'data_types', 0, "
        + " + ".join(invalid(c) for c in _PARSERS)
        + f" + {hits(q(CONTRACT_NUMBER) + chr(32) + 'like ' + text('%.0'))} from raw",
        f"select 'missing_values', {hits(any_null(CRITICAL))}, {hits(any_null(WARNING))} from raw",
        "select 'business_rules', 0, "
        + " + ".join(
            hits(f"({money(q(c))}) < 0") + " + " + hits(f"abs({money(q(c))}) > 1000000")
            for c in AMOUNTS
        )
        + " + "
        + " + ".join(hits(t) for t in [*_RULES.values(), _YEAR_DIFFERS])
        + " from raw",
        "select 'time_coverage', count(*) filter (where fy is null), "
        f"{nulls(q(PO_DATE))} + {_MISMATCH} from times",
        "select 'duplicates', 0, (select sum(n - 1) from row_counts) + "
        "(select sum(n - 1) from key_counts where key_name = 'purchase_order')",
        "select 'dimensions', 0, sum(whitespace_issue_count) + "
        "sum(stripped_unique_count - lower_unique_count) from cardinality",
    ]
) + ")"
_FOUND = (
    "found as (select \"check\", cast(failures as bigint) as failures, "
    "cast(warnings as bigint) as warnings from findings union all "
    "select 'overall', cast(sum(failures) as bigint), cast(sum(warnings) as bigint) from findings)"
)
ORACLE["readiness_summary"] = ORACLE["readiness_from_reports"] = over(
    "hashed",
    "select \"check\", case when \"check\" = 'overall' then case when failures > 0 then "
    "'NOT_READY' when warnings > 0 then 'READY_WITH_WARNINGS' else 'READY' end "
    "when failures > 0 then 'FAIL' when warnings > 0 then 'PASS_WITH_WARNINGS' else 'PASS' end "
    "as status, failures, warnings from found",
    _WIDTHS,
    _TIMES,
    _KEYS,
    _ROWS,
    _DIMS,
    _DIM_FORMS,
    _CARDINALITY,
    _FINDINGS,
    _FOUND,
)
