"""Plain SQL for the registered queries, written as the joins one would write by hand.

The Spark side never builds the joined rows that these queries fan out to.
"""

from __future__ import annotations

import re

from .. import sample
from .exports import DAMAGED_LINE, MIXED_CR
from .queries import LOOKUP_KEYS

LO, HI = sample.PERIOD.start, sample.PERIOD.end
YEARS = ", ".join(f"'{y}'" for y in sample.CONFIG.contractor_years)
FLAG = sample.CONFIG.flagged_provider
LABELS = f"'{sample.CONFIG.flagged_label}' ELSE '{sample.CONFIG.unflagged_label}'"


def day(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches(left({column}, 10), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
        f"THEN TRY_CAST(left({column}, 10) AS DATE) END"
    )


def year(d: str) -> str:
    return f"CAST(year({d}) AS INTEGER)"


def month(d: str) -> str:
    return f"CAST(month({d}) AS INTEGER)"


def usd(column: str) -> str:
    return f"TRY_CAST({column} AS DECIMAL(18,2))"


SCOPE = (
    "direction = 'OUTGOING' AND platform_type = 'Withdrawal' AND type <> 'Returned' "
    "AND receiver_id IS NULL AND sender_id IS NULL AND return_id IS NULL"
)
_PARTS = {
    **sample.ledger_sql(),
    "p": f"SELECT *, {day('withdrawal_created_at')} AS d FROM full_payout",
    "b": f"SELECT *, {day('created_at')} AS d FROM full_bank",
    "payout": f"SELECT * FROM p WHERE d >= DATE '{LO}' AND d < DATE '{HI}'",
    "bank": f"SELECT * FROM b WHERE d >= DATE '{LO}' AND d < DATE '{HI}' AND {SCOPE}",
    "bank_grouped": f"SELECT reconciliation_id, provider, sum({usd('usd_amount')}) AS usd FROM bank GROUP BY ALL",
    "apcw": f"SELECT * FROM payment WHERE purpose = 'contractor_payment' AND left(created_at, 4) IN ({YEARS})",
    "p_only": "SELECT * FROM payout x WHERE NOT EXISTS "
    "(SELECT 1 FROM bank y WHERE y.reconciliation_id = x.tms_reconciliation_id)",
}


def _sql(body: str, more: dict[str, str] | None = None) -> str:
    """The query behind the ledgers it refers to, directly or through another one."""
    parts = {**_PARTS, **(more or {})}
    needed: set[str] = set()
    queue = [body]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        new = [name for name in parts if name in words and name not in needed]
        needed.update(new)
        queue.extend(parts[name] for name in new)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in parts.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


PAYOUT_COLS = (
    "tms_reconciliation_id, withdrawal_created_at, total_cashout_usd, initial_withdrawal_amount_usd, "
    "payment_provider_name, payment_method, tms_is_reconciled"
)
BANK_COLS = (
    "reconciliation_id, platform_id, provider, usd_amount, created_at, direction, platform_type, "
    "type, receiver_id, sender_id, return_id"
)
PROVIDER_FLAG = f"CASE WHEN lower(trim(payment_provider_name)) = '{FLAG}' THEN {LABELS} END"
DIFF_COLS = (
    "count(*) AS cnt, sum({a}) AS sum_total_cashout_usd, sum({b}) AS sum_tms_usd_amount, "
    "sum({a} - {b}) AS sum_diff_usd"
)
CASH = usd("total_cashout_usd")
INIT = usd("initial_withdrawal_amount_usd")
AMOUNT = usd("usd_amount")

CUTOFF = f"""
SELECT {year('f.d')} AS tms_cutoff_year, {month('f.d')} AS tms_cutoff_month, {PROVIDER_FLAG} AS provider_flag,
       CASE WHEN x.tms_reconciliation_id IS NOT NULL THEN 'recon_id_exist' ELSE 'no_recon_id' END AS if_recon_id,
       count(*) AS cnt, sum({INIT}) AS sum_initial_withdrawal_usd, sum({CASH}) AS sum_total_cashout_usd
FROM p_only x LEFT JOIN {{full}} f ON x.tms_reconciliation_id = f.reconciliation_id
GROUP BY 1, 2, 3, 4"""

BANK_CUTOFF = (
    f"SELECT {year('f.d')} AS payout_from_year, {month('f.d')} AS payout_from_month, "
    "CASE WHEN f.tms_reconciliation_id IS NOT NULL THEN 1 ELSE 0 END AS exists_in_full_payout, "
    "CASE WHEN t.withdrawal_id IS NOT NULL THEN 'contractor_withdrawal' ELSE 'other_withdrawal' END AS withdrawal_type, "
    f"a.status, count(*) AS cnt, sum({AMOUNT}) AS sum_usd_amount FROM b_only t "
    "LEFT JOIN (SELECT * FROM p WHERE d IS NOT NULL) f ON t.reconciliation_id = f.tms_reconciliation_id "
    "LEFT JOIN apcw a ON t.withdrawal_id = a.withdrawal_id GROUP BY 1, 2, 3, 4, 5"
)
MULTI = "(length(text) - length(replace(text, chr(10), '')))"
DAMAGED = "o_orderkey % 101 = 0 OR o_orderkey % 103 = 0"
VALUE_COUNT = "SELECT '{c}' AS column_name, {c} AS value, count(*) AS cnt FROM {t} GROUP BY {c}"


def _tagged(how: str, body: str) -> str:
    """A query on the bank rows with their payments (tagged) that no payout has (b_only)."""
    return _sql(
        body,
        {
            "tagged": f"SELECT k.*, a.withdrawal_id FROM bank k {how} JOIN apcw a ON k.platform_id = a.withdrawal_id",
            "b_only": "SELECT * FROM tagged t WHERE NOT EXISTS "
            "(SELECT 1 FROM payout y WHERE y.tms_reconciliation_id = t.reconciliation_id)",
        },
    )


_REPORTED = (
    "SELECT t.table_name, m.metric, m.value FROM "
    "(VALUES ('full_payout'), ('full_bank'), ('ar_ledger')) t(table_name), "
    f"(SELECT 'rows' AS metric, CAST(count(*) AS DECIMAL(38,2)) AS value FROM orders "
    f"UNION ALL SELECT 'usd', CAST(sum({sample.PRICE}) AS DECIMAL(38,2)) FROM orders) m"
)
_ACTUAL = " UNION ALL ".join(
    [
        "SELECT 'full_payout' AS table_name, 'rows' AS metric, CAST(count(*) AS DECIMAL(38,2)) AS value FROM full_payout",
        f"SELECT 'full_payout', 'usd', CAST(sum({CASH}) AS DECIMAL(38,2)) FROM full_payout",
        "SELECT 'full_bank', 'rows', CAST(count(*) AS DECIMAL(38,2)) FROM full_bank",
        f"SELECT 'full_bank', 'usd', CAST(sum({AMOUNT}) AS DECIMAL(38,2)) FROM full_bank",
        "SELECT 'ar_ledger', 'rows', CAST(count(*) AS DECIMAL(38,2)) FROM ar_ledger",
    ]
)


def _tie_side(side: str, source: str, key: str, amount: str, other: str) -> str:
    """Three separate figures and what they leave over."""

    def figures(where: str = "") -> str:
        print_ = f"coalesce(sum(CAST(hash({key}, {amount}) AS HUGEINT)), 0)"
        return f"SELECT count(*) AS n, coalesce(sum({amount}), 0) AS usd, {print_} AS print FROM {source} s {where}"

    hit = f"EXISTS (SELECT 1 FROM {other})"
    return (
        f"SELECT '{side}' AS side, t.n AS total_rows, m.n AS matched_rows, u.n AS unmatched_rows, "
        "t.usd AS total_usd, m.usd AS matched_usd, u.usd AS unmatched_usd, d.n AS duplicate_keys, "
        "t.n - m.n - u.n AS residual_rows, t.usd - m.usd - u.usd AS residual_usd, "
        "CAST(t.print - m.print - u.print AS DECIMAL(38,0)) AS fingerprint_residual "
        f"FROM ({figures()}) t, ({figures('WHERE ' + hit)}) m, ({figures('WHERE NOT ' + hit)}) u, "
        f"(SELECT count(*) AS n FROM (SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1 "
        "HAVING count(*) > 1)) d"
    )


def _lines(name: str, columns: str, source: str) -> str:
    """Every row as one text."""
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns.split(", "))
    return f"SELECT '{name}' AS table_name, concat_ws(' | ', {cells}) AS line FROM {source}"


ORACLES: dict[str, str] = {
    "join_diff": _sql(
        f"SELECT {DIFF_COLS.format(a=CASH, b='g.usd')} FROM payout x JOIN bank_grouped g "
        "ON x.tms_reconciliation_id = g.reconciliation_id"
    ),
    "join_diff_by_method": _sql(
        f"SELECT payment_method, {DIFF_COLS.format(a=CASH, b='g.usd')} FROM payout x JOIN bank_grouped g "
        f"ON x.tms_reconciliation_id = g.reconciliation_id WHERE {CASH} - g.usd <> 0 GROUP BY 1"
    ),
    "join_diff_no_preagg": _sql(
        f"SELECT payment_method, {DIFF_COLS.format(a=CASH, b=AMOUNT)} FROM payout x JOIN bank k "
        f"ON x.tms_reconciliation_id = k.reconciliation_id WHERE {CASH} - {AMOUNT} <> 0 GROUP BY 1"
    ),
    "payout_not_bank_cutoff": _sql(CUTOFF.format(full="b")),
    "payout_not_bank_cutoff_earliest": _sql(
        CUTOFF.format(full="(SELECT reconciliation_id, min(d) AS d FROM b GROUP BY 1)")
    ),
    "payout_not_bank_cutoff_scoped": _sql(
        f"SELECT {year('f.d')} AS cutoff_year, {month('f.d')} AS cutoff_month, {PROVIDER_FLAG} AS provider_flag, "
        f"count(*) AS cnt, sum({INIT}) AS sum_initial_withdrawal_usd FROM p_only x "
        f"LEFT JOIN (SELECT * FROM b WHERE {SCOPE}) f ON x.tms_reconciliation_id = f.reconciliation_id "
        "GROUP BY 1, 2, 3"
    ),
    "payout_not_bank_totals": _sql(
        f"SELECT count(*) AS cnt, sum({INIT}) AS sum_initial_withdrawal_usd, "
        f"sum({CASH}) AS sum_total_cashout_usd FROM p_only"
    ),
    "payout_unmatched_rows": _sql(f"SELECT {PAYOUT_COLS}, CAST(d AS VARCHAR) AS withdrawal_date FROM p_only"),
    "payout_unresolved_detail": _sql(
        f"SELECT {PAYOUT_COLS}, CAST(x.d AS VARCHAR) AS withdrawal_date FROM p_only x "
        "WHERE NOT EXISTS (SELECT 1 FROM b f WHERE f.reconciliation_id = x.tms_reconciliation_id) "
        f"AND x.tms_reconciliation_id IS NOT NULL AND lower(trim(payment_provider_name)) <> '{FLAG}'"
    ),
    "payout_undated_detail": _sql(
        f"SELECT {', '.join('x.' + c for c in PAYOUT_COLS.split(', '))}, CAST(x.d AS VARCHAR) AS withdrawal_date, "
        "count(f.reconciliation_id) AS bank_rows FROM p_only x "
        "LEFT JOIN b f ON x.tms_reconciliation_id = f.reconciliation_id WHERE f.d IS NULL "
        f"GROUP BY {', '.join('x.' + c for c in PAYOUT_COLS.split(', '))}, x.d"
    ),
    "bank_not_payout_cutoff": _tagged("LEFT", BANK_CUTOFF),
    "bank_not_payout_by_status": _tagged(
        "INNER",
        f"SELECT {year('f.d')} AS cutoff_year, {month('f.d')} AS cutoff_month, a.status, count(*) AS cnt, "
        f"sum({AMOUNT}) AS sum_usd_amount FROM b_only t "
        "LEFT JOIN p f ON t.reconciliation_id = f.tms_reconciliation_id "
        "LEFT JOIN apcw a ON t.platform_id = a.withdrawal_id GROUP BY 1, 2, 3",
    ),
    "bank_not_payout_contractor": _tagged(
        "INNER",
        f"SELECT {year('t.d')} AS cutoff_year, {month('t.d')} AS cutoff_month, count(*) AS cnt, "
        f"sum({AMOUNT}) AS sum_usd_amount FROM b_only t "
        "LEFT JOIN full_payout f ON t.reconciliation_id = f.tms_reconciliation_id GROUP BY 1, 2",
    ),
    "bank_not_payout_totals": _sql(
        "SELECT count(*) AS tms_not_in_payout_cnt, sum(usd) AS tms_not_in_payout_usd_sum FROM bank_grouped g "
        "WHERE NOT EXISTS (SELECT 1 FROM payout y WHERE y.tms_reconciliation_id = g.reconciliation_id)"
    ),
    "bank_unmatched_rows": _sql(
        f"SELECT {BANK_COLS} FROM bank k WHERE NOT EXISTS "
        "(SELECT 1 FROM payout y WHERE y.tms_reconciliation_id = k.reconciliation_id)"
    ),
    "bank_contractor_rows": _sql(
        f"SELECT {', '.join('k.' + c for c in BANK_COLS.split(', '))}, 'contractor_withdrawal' AS withdrawal_type, "
        "n AS payment_rows FROM bank k JOIN (SELECT withdrawal_id, count(*) AS n FROM apcw GROUP BY 1) a "
        "ON k.platform_id = a.withdrawal_id"
    ),
    "bank_tagged_rows": _sql(
        f"SELECT {', '.join('k.' + c for c in BANK_COLS.split(', '))}, "
        "CASE WHEN n IS NULL THEN 'other_withdrawal' ELSE 'contractor_withdrawal' END AS withdrawal_type, "
        "coalesce(n, 0) AS payment_rows FROM bank k "
        "LEFT JOIN (SELECT withdrawal_id, count(*) AS n FROM apcw GROUP BY 1) a ON k.platform_id = a.withdrawal_id"
    ),
    "control_totals": _sql(
        f"SELECT count(*) AS cnt, sum({CASH}) AS sum_total_cashout_usd, "
        f"sum({INIT}) AS sum_initial_withdrawal_usd FROM payout"
    ),
    "bank_control_totals": _sql(f"SELECT count(*) AS cnt, sum({AMOUNT}) AS sum_tms_usd_amount FROM bank"),
    "tie_out": _sql(
        _tie_side("payout", "payout", "tms_reconciliation_id", CASH, "bank y WHERE y.reconciliation_id = s.tms_reconciliation_id")
        + " UNION ALL "
        + _tie_side("bank", "bank_grouped", "reconciliation_id", "usd", "payout y WHERE y.tms_reconciliation_id = s.reconciliation_id")
    ),
    "control_compare": _sql(
        "SELECT coalesce(a.table_name, r.table_name) AS table_name, coalesce(a.metric, r.metric) AS metric, "
        "r.value AS expected, a.value AS actual, a.value - r.value AS diff, "
        "CASE WHEN a.value IS NULL OR r.value IS NULL THEN 'missing' WHEN a.value = r.value THEN 'ok' "
        f"ELSE 'differs' END AS verdict FROM ({_ACTUAL}) a FULL JOIN ({_REPORTED}) r "
        "ON a.table_name = r.table_name AND a.metric = r.metric"
    ),
    "table_counts": _sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS cnt FROM {t}"
            for t in ("ar_ledger", "clearing", "full_bank", "full_payout", "payment")
        )
    ),
    "dup_keys": _sql(
        "SELECT reconciliation_id, count(*) AS cnt FROM bank WHERE reconciliation_id IS NOT NULL "
        "GROUP BY 1 HAVING count(*) > 1"
    ),
    "payout_dup_keys": _sql(
        "SELECT tms_reconciliation_id, count(*) AS cnt FROM payout WHERE tms_reconciliation_id IS NOT NULL "
        "GROUP BY 1 HAVING count(*) > 1"
    ),
    "dup_by_provider": _sql(
        "SELECT provider, count(*) AS counters FROM (SELECT reconciliation_id, provider FROM bank "
        "GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1"
    ),
    "null_keys": _sql(f"SELECT {PAYOUT_COLS} FROM full_payout WHERE tms_reconciliation_id IS NULL"),
    "value_counts": _sql(
        " UNION ALL ".join(
            VALUE_COUNT.format(c=c, t=t)
            for c, t in (
                ("type", "full_bank"),
                ("platform_type", "full_bank"),
                ("direction", "full_bank"),
                ("settlement_currency", "payment"),
                ("purpose", "payment"),
                ("tms_is_reconciled", "full_payout"),
            )
        )
    ),
    "month_histogram": _sql(
        f"SELECT {year('d')} AS year, {month('d')} AS month, count(*) AS record_count FROM b GROUP BY 1, 2"
    ),
    "drilldown": _sql(
        f"SELECT direction, receiver_id, sender_id, count(*) AS record_count, sum({AMOUNT}) AS sum_usd_amount "
        "FROM full_bank GROUP BY 1, 2, 3"
    ),
    "key_lookup": _sql(
        f"SELECT {BANK_COLS} FROM full_bank WHERE reconciliation_id IN ({', '.join(repr(str(k)) for k in LOOKUP_KEYS)})"
    ),
    "provider_filter": _sql(
        "SELECT lower(trim(payment_provider_name)) AS provider, count(*) AS cnt FROM full_payout "
        f"WHERE lower(trim(payment_provider_name)) <> '{FLAG}' GROUP BY 1"
    ),
    "ledger_pivot": _sql(
        f"SELECT analytics_ns_mapping, count(*) AS record_count, sum({usd('amount_usd')}) AS total_amount "
        "FROM ar_ledger GROUP BY 1"
    ),
    "ledger_months": _sql(
        f"SELECT {year(day('posting_date'))} AS year, {month(day('posting_date'))} AS month, "
        "count(*) AS record_count FROM ar_ledger GROUP BY 1, 2"
    ),
    "ledger_rows": _sql(
        f"SELECT count(*) AS cnt, sum({usd('amount_usd')}) AS total_amount FROM ar_ledger"
    ),
    "distinct_dates": _sql("SELECT DISTINCT reversal_date FROM ar_ledger"),
    "period_sum": _sql(
        f"SELECT invoice_period, count(*) AS record_count, sum({AMOUNT}) AS total_amount FROM clearing GROUP BY 1"
    ),
    "first_n": _sql("SELECT * FROM ar_ledger ORDER BY unique_key LIMIT 100"),
    "period_range": _sql(f"SELECT {PAYOUT_COLS} FROM payout"),
    "period_year_month": _sql(
        f"SELECT {PAYOUT_COLS} FROM p WHERE d IS NOT NULL AND year(d) = 1998 AND month(d) IN (10, 11, 12)"
    ),
    "scope_filter": _sql(f"SELECT {BANK_COLS} FROM full_bank WHERE {SCOPE}"),
    "year_prefix_filter": _sql(f"SELECT * FROM payment WHERE left(created_at, 4) IN ({YEARS})"),
    "typed_ledger": _sql(
        f"SELECT {PAYOUT_COLS}, CAST(d AS VARCHAR) AS ledger_day, strftime(d, '%Y-%m') AS ledger_month, "
        f"{CASH} AS total_cashout_usd_typed, {INIT} AS initial_withdrawal_amount_usd_typed FROM p"
    ),
    "csv_roundtrip": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents",
    "csv_small_files": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents",
    "csv_unquoted": "SELECT CAST(c_custkey AS VARCHAR) AS custkey, '\"' || c_mktsegment AS segment, "
    "c_name || '\"' AS name FROM customer",
    "csv_inferred": "SELECT o_orderstatus, count(*) AS cnt, CAST(sum(o_custkey) AS BIGINT) AS sum_custkey, "
    f"sum({sample.PRICE}) AS sum_price FROM orders GROUP BY 1",
    "empty_to_null": _sql(f"SELECT provider, count(*) AS cnt FROM full_bank WHERE {SCOPE} GROUP BY 1"),
    "json_keys": _sql(
        "SELECT unique_key FROM ar_ledger l WHERE NOT EXISTS "
        "(SELECT 1 FROM ar_loaded t WHERE t.unique_key = l.unique_key)"
    ),
    "load_with_reject_cap": "SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS order_status, "
    "o_orderpriority AS priority FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0",
    "load_unquoted_with_cap": "SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS order_status, "
    "'\"' || o_orderpriority || '\"' AS priority FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0",
    "reject_summary": "SELECT count(*) FILTER (WHERE NOT bad) AS loaded, count(*) FILTER (WHERE bad) AS rejected, "
    "CAST(0 AS BIGINT) AS open_quotes, count(*) // 20 AS cap, "
    "count(*) FILTER (WHERE bad) <= count(*) // 20 AS accepted "
    "FROM (SELECT o_orderkey % 101 = 0 OR o_orderkey % 103 = 0 AS bad FROM orders)",
    "rejected_records": f"SELECT {DAMAGED_LINE} AS raw, "
    "CASE WHEN o_orderkey % 101 = 0 THEN 2 ELSE 4 END AS fields, 3 AS expected "
    "FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0",
    "replace_table": _sql(f"SELECT {PAYOUT_COLS} FROM payout"),
    "typed_ledger_months": _sql(
        "SELECT strftime(d, '%Y-%m') AS ledger_month, count(*) AS cnt, "
        f"sum({CASH}) AS sum_total_cashout_usd FROM payout GROUP BY 1"
    ),
    "report_csv": _sql(
        "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (" + CUTOFF.format(full="b").strip() + ")"
    ),
    "table_from_csv": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
    "o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority FROM orders",
    "load_all": " UNION ALL ".join(
        [
            _lines("documents", "doc_id, md5(text), lang, source", "documents"),
            _lines("orders", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority", "orders"),
            _lines("customers", "c_custkey, '\"' || c_mktsegment, c_name || '\"'", "customer"),
            _lines("damaged", "o_orderkey, o_orderstatus, o_orderpriority", f"orders WHERE NOT ({DAMAGED})"),
            _lines(
                "damaged_rejects",
                "raw, CASE WHEN o_orderkey % 101 = 0 THEN 2 ELSE 4 END, 3",
                f"(SELECT *, {DAMAGED_LINE} AS raw FROM orders) WHERE {DAMAGED}",
            ),
        ]
    ),
    "run_all": _tagged(
        "LEFT",
        " UNION ALL ".join(
            [
                _lines(
                    "join_diff",
                    "cnt, sum_total_cashout_usd, sum_tms_usd_amount, sum_diff_usd",
                    f"(SELECT {DIFF_COLS.format(a=CASH, b='g.usd')} FROM payout x JOIN bank_grouped g "
                    "ON x.tms_reconciliation_id = g.reconciliation_id)",
                ),
                _lines(
                    "payout_not_bank",
                    "tms_cutoff_year, tms_cutoff_month, provider_flag, if_recon_id, cnt, "
                    "sum_initial_withdrawal_usd, sum_total_cashout_usd",
                    f"({CUTOFF.format(full='b')})",
                ),
                _lines(
                    "bank_not_payout",
                    "payout_from_year, payout_from_month, exists_in_full_payout, withdrawal_type, status, "
                    "cnt, sum_usd_amount",
                    f"({BANK_CUTOFF})",
                ),
            ]
        ),
    ),
    "load_metrics": f"SELECT 'documents' AS table_name, CAST(sum(1 + {MULTI}) AS BIGINT) AS data_lines, "
    f"count(*) AS loaded_rows, CAST(0 AS BIGINT) AS rejected_rows, sum({MULTI}) = 0 AS matches FROM documents "
    "UNION ALL SELECT 'orders', count(*), count(*), 0, true FROM orders "
    "UNION ALL SELECT 'customers', count(*), count(*), 0, true FROM customer "
    f"UNION ALL SELECT 'damaged', count(*), count(*) FILTER (WHERE NOT ({DAMAGED})), "
    f"count(*) FILTER (WHERE {DAMAGED}), true FROM orders",
    "load_in_batches": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
    "o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority, 0 AS added_again FROM orders",
    "switch_table": _sql(f"SELECT {PAYOUT_COLS} FROM payout"),
    "sql_script": _sql(
        f"SELECT 1 AS statement, 'payout; period' AS label, count(*) AS cnt FROM full_payout "
        f"WHERE left(withdrawal_created_at, 10) >= '{LO}' AND left(withdrawal_created_at, 10) < '{HI}' "
        f"UNION ALL SELECT 2, 'bank', count(*) FROM full_bank "
        f"WHERE left(created_at, 10) >= '{LO}' AND left(created_at, 10) < '{HI}' "
        "UNION ALL SELECT 3, 'doubled ' || payment_method, count(*) FROM (SELECT tms_reconciliation_id, payment_method "
        "FROM full_payout WHERE tms_reconciliation_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY payment_method"
    ),
    "sql_report": _sql(
        f"SELECT lower(trim(payment_provider_name)) AS provider, count(*) AS cnt, "
        f"sum({CASH}) AS sum_total_cashout_usd FROM payout GROUP BY 1"
    ),
    "missing_rows": _sql(
        "SELECT * FROM ar_ledger l WHERE NOT EXISTS "
        "(SELECT 1 FROM ar_loaded t WHERE t.unique_key = l.unique_key)"
    ),
    "first_missing": _sql(
        "SELECT unique_key FROM ar_ledger l WHERE NOT EXISTS "
        "(SELECT 1 FROM ar_loaded t WHERE t.unique_key = l.unique_key) ORDER BY unique_key LIMIT 20"
    ),
    "missing_csv_records": _sql(
        "SELECT * FROM ar_ledger l WHERE NOT EXISTS "
        "(SELECT 1 FROM ar_loaded t WHERE t.unique_key = l.unique_key)"
    ),
    "line_vs_record_count": f"SELECT CAST(sum(1 + {MULTI}) AS BIGINT) AS expected_lines, count(*) AS loaded_rows, "
    f"CAST(sum({MULTI}) AS BIGINT) AS diff, sum({MULTI}) = 0 AS matches FROM documents",
    "record_shape": "SELECT count(*) AS records, CAST(4 AS BIGINT) AS columns FROM documents",
    "multiline_records": f"SELECT {MULTI} AS extra_physical_lines, CAST(doc_id AS VARCHAR) AS unique_key, "
    "'1' AS fields_with_newline_indexes, 'text' AS fields_with_newline_names, "
    "'text: ' || CASE WHEN length(e) > 120 THEN left(e, 120) || '...' ELSE e END AS preview "
    "FROM (SELECT *, replace(text, chr(10), '\\n') AS e FROM documents) WHERE contains(text, chr(10))",
    "multiline_totals": "SELECT count(*) AS scanned_records, "
    "count(*) FILTER (WHERE contains(text, chr(10))) AS multiline_records, "
    f"CAST(sum({MULTI}) AS BIGINT) AS extra_physical_lines FROM documents",
    "bad_structure": "SELECT CASE WHEN o_orderkey % 101 = 0 THEN 2 ELSE 4 END AS actual_fields, "
    "3 AS expected_fields, CASE WHEN o_orderkey % 101 = 0 THEN concat_ws(' | ', o_orderkey, o_orderstatus) "
    "ELSE concat_ws(' | ', o_orderkey, o_orderstatus, o_orderpriority, 'extra') END AS preview "
    "FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0",
    "record_positions": f"SELECT count(*) AS records, CAST(sum(1 + {MULTI}) AS BIGINT) AS lines, "
    "CAST(0 AS BIGINT) AS faults, CAST(0 AS BIGINT) AS wrong_ends FROM documents",
    "quote_balance": f"SELECT count(*) AS records, CAST(sum(1 + {MULTI}) AS BIGINT) AS lines, "
    "CAST(0 AS BIGINT) AS odd_files, CAST(0 AS BIGINT) AS open_records FROM documents",
    "terminator_profile": f"SELECT count(*) FILTER (WHERE {MIXED_CR}) AS crlf_lines, "
    f"count(*) FILTER (WHERE NOT {MIXED_CR}) AS lf_lines, 'LF' AS first_verdict, 'LF' AS last_verdict FROM orders",
}
ORACLES["run_all_bucketed"] = ORACLES["run_all"]
