"""The registered queries as plain SQL for a second engine (DuckDB).

Each text stands alone over the given tables: the bank-shaped views it needs
are inlined as ``bz_*``, their cleaned form as ``sv_*``. The marts are written
the direct way, join first and aggregate after, and so check the rewritten
Spark plans independently. Means of decimals use whole-number arithmetic, to
round as a decimal mean does.
"""

from __future__ import annotations

from lakemarts.operators.cleaning import PII_TERMS
from lakemarts.operators.lending import FREE_OF_FEES, INTEREST_BEARING
from lakemarts.registry.queries import RUN_TIME
from lakemarts.schemas import TABLES
from lakemarts.sources.bank_views import BANK_VIEWS, SPENDING_SECTORS, inputs_of

# --- inlined views ------------------------------------------------------------


def bronze_cte(view: str) -> str:
    text = BANK_VIEWS[view].replace("{ntz}", "TIMESTAMP")
    for name in inputs_of(view):
        text = text.replace("{" + name + "}", name)
    return f"bz_{view} AS ({text})"


def cleaned_columns(view: str) -> str:
    parts = []
    for field in TABLES[view].schema.fields:
        name = field.name
        if field.dataType.typeName() != "string":
            parts.append(name)
        elif any(term in name for term in PII_TERMS):
            parts.append(f"sha256(trim({name})) AS {name}")
        else:
            parts.append(f"nullif(trim({name}), '') AS {name}")
    return ", ".join(parts)


def silver_cte(view: str) -> str:
    return (
        f"{bronze_cte(view)}, "
        f"sv_{view} AS (SELECT DISTINCT {cleaned_columns(view)} FROM bz_{view})"
    )


def over_bronze(query: str, *views: str) -> str:
    return "WITH " + ", ".join(bronze_cte(view) for view in views) + "\n" + query


def over_silver(query: str, *views: str) -> str:
    return "WITH " + ", ".join(silver_cte(view) for view in views) + "\n" + query


def _over_cleaned(query: str) -> str:
    """Over the cleaned columns of all tables, copies of rows left in."""
    views = [
        f"{bronze_cte(view)}, cl_{view} AS (SELECT {cleaned_columns(view)} FROM bz_{view})"
        for view in TABLES
    ]
    return "WITH " + ", ".join(views) + "\n" + query


def strings_of(view: str) -> list[str]:
    return [f.name for f in TABLES[view].schema.fields if f.dataType.typeName() == "string"]


def replaced(view: str, change: dict[str, str]) -> str:
    """All columns of a view in order, some replaced by an expression."""
    return ", ".join(
        f"{change[name]} AS {name}" if name in change else name for name in TABLES[view].columns
    )


def decimal_mean(total: str, count: str, result: str = "DECIMAL(13,2)") -> str:
    """Mean of non-negative two-digit decimals, at six digits and then at two.

    Both roundings are half-up. ``total`` is a decimal sum, ``count`` a count.
    """
    six = (
        f"((2 * CAST({total} * 100 AS HUGEINT) * 10000 + {count})"
        f" // (2 * nullif({count}, 0)))"
    )
    return f"CAST(CAST(({six} + 5000) // 10000 AS DECIMAL(18,0)) / 100 AS {result})"


def mean_rounded_once(total: str, count: str, result: str) -> str:
    """As :func:`decimal_mean`, with one half-up rounding."""
    cents = f"((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * nullif({count}, 0)))"
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) / 100 AS {result})"


# --- marts: join, then aggregate ----------------------------------------------

M1 = """SELECT c.customer_uuid, c.city, c.country, c.employment_status, c.customer_segment,
  c.annual_income,
  count(DISTINCT a.account_id) AS total_accounts_owned,
  CAST(round(coalesce(sum(a.current_balance), 0), 2) AS DECIMAL(26,2)) AS total_deposit_balance,
  max(s.bureau_score) AS bureau_credit_score,
  max(s.risk_rating) AS credit_risk_rating,
  max(s.debt_to_income_ratio) AS dti_ratio,
  max(s.delinquency_history_count) AS missed_payments_count
FROM sv_customers c
LEFT JOIN sv_accounts a ON c.customer_uuid = a.customer_uuid
LEFT JOIN sv_credit_scores s ON c.customer_uuid = s.customer_uuid
GROUP BY ALL"""

M2 = f"""SELECT date_trunc('month', transaction_timestamp)::TIMESTAMP AS transaction_month,
  transaction_type, spending_sector, channel, status, transaction_city,
  count(transaction_id) AS total_transaction_count,
  CAST(sum(amount) AS DECIMAL(23,2)) AS total_transaction_amount,
  {decimal_mean("sum(amount)", "count(amount)")} AS avg_transaction_amount
FROM sv_transactions GROUP BY ALL"""

_REPAID = ",\n  ".join(
    f"CAST(coalesce(sum(r.{column}), 0) AS {kind}) AS {name}"
    for column, kind, name in (
        ("amount_paid", "DECIMAL(23,2)", "total_amount_repaid"),
        ("principal_component", "DECIMAL(23,2)", "principal_repaid_component"),
        ("interest_component", "DECIMAL(23,2)", "interest_profit_earned"),
        ("late_fee_applied", "DECIMAL(19,2)", "total_late_fees_collected"),
    )
)
_LOANS_JOINED = f"""SELECT l.loan_type, l.loan_status, l.term_months,
  count(DISTINCT l.loan_id) AS total_loans_count,
  CAST(sum(l.principal_amount) AS DECIMAL(26,2)) AS total_principal_borrowed,
  {_REPAID}
FROM sv_loan_applications l LEFT JOIN sv_loan_repayments r ON l.loan_id = r.loan_id
GROUP BY ALL"""
M3 = _LOANS_JOINED
M3_EXACT = f"""SELECT j.* REPLACE (p.principal AS total_principal_borrowed)
FROM ({_LOANS_JOINED}) j JOIN (
  SELECT loan_type, loan_status, term_months,
    CAST(sum(principal_amount) AS DECIMAL(26,2)) AS principal
  FROM sv_loan_applications GROUP BY ALL
) p ON j.loan_type IS NOT DISTINCT FROM p.loan_type
  AND j.loan_status IS NOT DISTINCT FROM p.loan_status
  AND j.term_months IS NOT DISTINCT FROM p.term_months"""

M4 = """SELECT alert_type, status, count(alert_id) AS total_alerts_raised,
  round(avg(risk_score), 2) AS avg_risk_score, max(risk_score) AS max_risk_score
FROM sv_fraud_alerts GROUP BY ALL"""

MARTS = {
    "mart_financial_health": (M1, ("customers", "accounts", "credit_scores")),
    "mart_transactions": (M2, ("transactions",)),
    "mart_loans": (M3, ("loan_applications", "loan_repayments")),
    "mart_loans_exact": (M3_EXACT, ("loan_applications", "loan_repayments")),
    "mart_fraud": (M4, ("fraud_alerts",)),
}


def over_mart(query: str, mart: str) -> str:
    text, views = MARTS[mart]
    return over_silver(query.replace("MART", f"({text})"), *views)


# --- audits -------------------------------------------------------------------


def counts(prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS record_count FROM {prefix}{name}"
        for name in TABLES
    )


def rule_counts(prefix: str, rules: dict[tuple[str, str], str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name,"
        f" count(*) FILTER (WHERE {broken}) AS violations FROM {prefix}{table}"
        for (table, column), broken in rules.items()
    )


NOT_NULL = {(t, c): f"{c} IS NULL" for t, spec in TABLES.items() for c in spec.required}
CHECKS = {
    (t, r.column): f"{r.column} < {r.low} OR {r.column} > {r.high}"
    for t, spec in TABLES.items()
    for r in spec.ranges
}
LENGTHS = {
    (t, c): f"length({c}) > {n}" for t, spec in TABLES.items() for c, n in spec.lengths.items()
}
UNIQUE = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{key}' AS column_name, count(*) AS repeated_keys,"
    f" CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM"
    f" (SELECT count(*) AS n FROM bz_{t} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
    for t, spec in TABLES.items()
    for key in spec.unique_keys
)


def reference_counts(kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{ref.column}' AS column_name,"
        f" '{ref.parent}' AS parent_table, count(DISTINCT {ref.column}) AS orphan_keys,"
        f" count(*) AS orphan_rows FROM bz_{t} child WHERE {ref.column} IS NOT NULL AND NOT EXISTS"
        f" (SELECT 1 FROM bz_{ref.parent} parent WHERE parent.{ref.parent_column} = child.{ref.column})"
        for t, spec in TABLES.items()
        for ref in getattr(spec, kind)
    )


def _violations(rule: str, column: str, query: str) -> str:
    return f"SELECT '{rule}' AS rule, table_name, column_name, {column} AS violations FROM ({query})"


def broken_rules() -> str:
    found = " UNION ALL ".join(
        [
            _violations("not null", "violations", rule_counts("sv_", NOT_NULL)),
            _violations("range", "violations", rule_counts("sv_", CHECKS)),
            _violations("length", "violations", rule_counts("bz_", LENGTHS)),
            _violations("unique", "surplus_rows", UNIQUE.replace("bz_", "sv_")),
            *[
                _violations(rule, "orphan_rows", reference_counts(kind).replace("bz_", "sv_"))
                for rule, kind in (("foreign key", "foreign_keys"), ("orphan", "soft_keys"))
            ],
        ]
    )
    return f"SELECT * FROM ({found}) WHERE violations > 0"


# --- profile and case repair --------------------------------------------------


def profile_of(view: str) -> str:
    per_column = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS v, lower(trim({c})) AS k FROM bz_{view}"
        for c in strings_of(view)
    )
    return f""", cells AS ({per_column}), variants AS (
  SELECT column_name, k FROM cells WHERE k <> ''
  GROUP BY column_name, k HAVING count(DISTINCT trim(v)) > 1)
SELECT column_name, count(*) AS total_rows,
  count(*) FILTER (WHERE v IS NULL) AS null_rows,
  count(*) FILTER (WHERE k = '') AS blank_rows,
  count(*) FILTER (WHERE k <> '' AND trim(v) <> v) AS padded_rows,
  count(DISTINCT trim(v)) FILTER (WHERE k <> '') AS values_seen,
  count(DISTINCT k) FILTER (WHERE k <> '') AS values_merged,
  count(*) FILTER (WHERE (column_name, k) IN (SELECT (column_name, k) FROM variants))
    AS variant_rows
FROM cells GROUP BY column_name"""


_SECTOR_ROWS = ", ".join(f"('{sector}')" for sector in SPENDING_SECTORS)

_INSTALMENT = """SELECT loan_id, principal_amount, interest_rate, term_months,
  CAST(CAST(a AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS instalment_amount,
  CAST(CAST(i AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS interest_component,
  CAST(CAST(a - i AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS principal_component
FROM (SELECT *, (2 * a * CAST(interest_rate * 100 AS HUGEINT) + 120000) // 240000 AS i
  FROM (SELECT *, (2 * CAST(principal_amount * 100 AS HUGEINT) + term_months)
    // (2 * term_months) AS a FROM bz_loan_applications))"""

_BEARING = " OR ".join(f"account_type LIKE '%{part}%'" for part in INTEREST_BEARING)

_ALL = tuple(TABLES)
_GOLD_COUNTS = " UNION ALL ".join(
    f"SELECT 'gold' AS layer, '{mart}' AS table_name, (SELECT count(*) FROM ({MARTS[key][0]}))"
    " AS record_count"
    for mart, key in (
        ("financial_health", "mart_financial_health"),
        ("transactions", "mart_transactions"),
        ("loans", "mart_loans"),
        ("loans_exact", "mart_loans_exact"),
        ("fraud", "mart_fraud"),
    )
)

_LEARNED = (
    "SELECT spelling, CAST(sum(n) OVER v AS BIGINT) AS value_rows, count(*) OVER v AS spellings"
    " FROM (SELECT trim(spending_sector) AS spelling, count(*) AS n FROM bz_transactions"
    " WHERE trim(spending_sector) <> '' GROUP BY 1)"
    " WINDOW v AS (PARTITION BY lower(spelling))"
    " QUALIFY row_number() OVER (PARTITION BY lower(spelling) ORDER BY n DESC, spelling) = 1"
)

ORACLES: dict[str, str] = {
    "bronze_load": over_bronze(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS record_count,"
            f" CAST(sum({spec.primary_key}) AS BIGINT) AS key_total FROM bz_{t}"
            for t, spec in TABLES.items()
        ),
        *_ALL,
    ),
    "bronze_load_messy": over_bronze(
        "SELECT * EXCLUDE (status, opened_date), 'Active' AS status,"
        f" DATE '{RUN_TIME.date()}' AS opened_date,"
        " '  branch ' || CAST(account_id % 7 AS VARCHAR) AS branch_note FROM bz_accounts",
        "accounts",
    ),
    "save_roundtrip": over_silver("SELECT * FROM sv_credit_cards", "credit_cards"),
    "lakehouse_refresh": over_silver(
        f"SELECT 'bronze' AS layer, * FROM ({counts('bz_')}) UNION ALL"
        f" SELECT 'silver' AS layer, * FROM ({counts('sv_')}) UNION ALL {_GOLD_COUNTS}",
        *_ALL,
    ),
    "sample_rows": over_bronze(
        "SELECT * FROM bz_credit_cards ORDER BY card_id LIMIT 1000", "credit_cards"
    ),
    "sample_repayments": over_bronze(
        "SELECT * FROM bz_loan_repayments ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in TABLES["loan_repayments"].columns)
        + " LIMIT 500",
        "loan_repayments",
    ),
    "clean_names": over_bronze("SELECT * FROM bz_customers", "customers"),
    "trim_strings": over_bronze(
        "SELECT "
        + replaced("customers", {c: f"trim({c})" for c in strings_of("customers")})
        + " FROM bz_customers",
        "customers",
    ),
    "mask_pii": over_bronze(
        "SELECT "
        + replaced(
            "customers",
            {c: f"sha256({c})" for c in ("first_name", "last_name", "email", "phone_number")},
        )
        + " FROM bz_customers",
        "customers",
    ),
    "blank_to_null": over_bronze(
        "SELECT "
        + replaced(
            "fraud_alerts",
            {c: f"CASE WHEN {c} <> '' THEN {c} END" for c in strings_of("fraud_alerts")},
        )
        + " FROM bz_fraud_alerts",
        "fraud_alerts",
    ),
    "dedup_rows": over_bronze(
        f"SELECT DISTINCT {cleaned_columns('customers')} FROM (SELECT * FROM bz_customers"
        " UNION ALL SELECT * REPLACE (first_name || ' ' AS first_name) FROM bz_customers)",
        "customers",
    ),
    "dedup_by_key": over_silver("SELECT * FROM sv_transactions", "transactions"),
    **{
        f"dedup_by_key_{case}": over_silver("SELECT * FROM sv_accounts", "accounts")
        for case in ("unique", "replay", "blocks")
    },
    **{f"silver_{t}": over_silver(f"SELECT * FROM sv_{t}", t) for t in TABLES},
    "month_trunc": over_bronze(
        "SELECT transaction_id, account_id, CAST(date_trunc('month', transaction_timestamp)"
        " AS TIMESTAMP) AS transaction_month FROM bz_transactions",
        "transactions",
    ),
    "round_half_up": over_bronze(
        "SELECT account_id, CAST(CAST(sign(b) * ((abs(b) * 2 + 8) // 16) AS DECIMAL(18,0)) / 100"
        " AS DECIMAL(18,2)) AS eighth FROM (SELECT account_id,"
        " CAST(current_balance * 100 AS BIGINT) AS b FROM bz_accounts)",
        "accounts",
    ),
    "coalesce_zero": over_bronze(
        "SELECT account_id, CAST(coalesce(current_balance, 0) AS DECIMAL(16,2))"
        " AS balance_or_zero FROM bz_accounts",
        "accounts",
    ),
    "left_join_accounts": over_silver(
        "SELECT c.customer_uuid, c.city, c.country, a.account_id, a.current_balance"
        " FROM sv_customers c LEFT JOIN sv_accounts a USING (customer_uuid)",
        "customers",
        "accounts",
    ),
    "left_join_chain": over_silver(
        "SELECT c.customer_uuid, c.city, c.country, a.account_id, a.current_balance,"
        " s.score_id, s.bureau_score, s.risk_rating"
        " FROM sv_customers c LEFT JOIN sv_accounts a ON c.customer_uuid = a.customer_uuid"
        " LEFT JOIN sv_credit_scores s ON c.customer_uuid = s.customer_uuid",
        "customers",
        "accounts",
        "credit_scores",
    ),
    "count_nonnull": over_bronze(
        "SELECT transaction_type, transaction_city, count(amount) AS amounts,"
        " count(*) AS all_rows FROM bz_transactions GROUP BY ALL",
        "transactions",
    ),
    "count_distinct": over_bronze(
        "SELECT transaction_type, channel, count(DISTINCT account_id) AS active_accounts"
        " FROM bz_transactions GROUP BY ALL",
        "transactions",
    ),
    "sum_decimal": over_bronze(
        "SELECT customer_uuid, CAST(sum(current_balance) AS DECIMAL(25,2)) AS balance"
        " FROM bz_accounts GROUP BY ALL",
        "accounts",
    ),
    "avg_decimal": over_bronze(
        "SELECT transaction_type, transaction_city,"
        f" {decimal_mean('sum(amount)', 'count(amount)')} AS avg_amount"
        " FROM bz_transactions GROUP BY ALL",
        "transactions",
    ),
    "avg_int": over_bronze(
        "SELECT status, round(avg(risk_score), 2) AS avg_risk_score"
        " FROM bz_fraud_alerts GROUP BY ALL",
        "fraud_alerts",
    ),
    "max_numeric": over_bronze(
        "SELECT delinquency_history_count, max(bureau_score) AS max_score,"
        " max(debt_to_income_ratio) AS max_dti FROM bz_credit_scores GROUP BY ALL",
        "credit_scores",
    ),
    "max_string": over_silver(
        "SELECT delinquency_history_count, max(risk_rating) AS max_rating"
        " FROM sv_credit_scores GROUP BY ALL",
        "credit_scores",
    ),
    **{key: over_silver(text, *views) for key, (text, views) in MARTS.items()},
    "row_counts": over_bronze(counts("bz_"), *_ALL),
    "row_counts_sorted": over_bronze(
        f"SELECT * FROM ({counts('bz_')}) ORDER BY record_count DESC, table_name", *_ALL
    ),
    "audit_not_null": _over_cleaned(rule_counts("cl_", NOT_NULL)),
    "broken_rules": over_silver(broken_rules(), *_ALL),
    "audit_unique": over_bronze(UNIQUE, *_ALL),
    "audit_fk": over_bronze(reference_counts("foreign_keys"), *_ALL),
    "audit_check": over_bronze(rule_counts("bz_", CHECKS), *_ALL),
    "audit_length": over_bronze(rule_counts("bz_", LENGTHS), *_ALL),
    "audit_orphans": over_bronze(reference_counts("soft_keys"), *_ALL),
    "apply_defaults": over_bronze(
        "SELECT * EXCLUDE (status, opened_date), 'Active' AS status,"
        f" DATE '{RUN_TIME.date()}' AS opened_date FROM bz_accounts",
        "accounts",
    ),
    "risk_band": over_bronze(
        "SELECT score_id, bureau_score, CASE WHEN bureau_score > 740 THEN 'Excellent'"
        " WHEN bureau_score > 670 THEN 'Good' WHEN bureau_score > 580 THEN 'Fair'"
        " WHEN bureau_score IS NOT NULL THEN 'Poor' END AS risk_band FROM bz_credit_scores",
        "credit_scores",
    ),
    "mask_card": over_bronze(
        "SELECT card_id, '****-****-****-' || right('4' || lpad(CAST(card_id AS VARCHAR), 15, '0'),"
        " 4) AS card_number_masked FROM bz_credit_cards",
        "credit_cards",
    ),
    "instalment_split": over_bronze(_INSTALMENT, "loan_applications"),
    "repayment_schedule": over_bronze(
        "SELECT loan_id, start_date, payments, payment_number,"
        " CAST(start_date - 30 * payment_number AS DATE) AS payment_date"
        " FROM (SELECT loan_id, start_date, payments,"
        " CAST(unnest(generate_series(1, payments)) AS INT) AS payment_number FROM ("
        "SELECT loan_id, start_date, CASE WHEN principal_amount IS NULL THEN 0"
        " ELSE 2 + loan_id % 10 END AS payments FROM bz_loan_applications))",
        "loan_applications",
    ),
    "cap_amount": over_bronze(
        "SELECT transaction_id, account_id, CASE WHEN amount > 15000 THEN 15000.00 ELSE amount END"
        "::DECIMAL(12,2) AS amount FROM bz_transactions",
        "transactions",
    ),
    "audit_product_rules": over_bronze(
        "SELECT account_id, account_type, 'interest' AS broken_rule FROM bz_accounts"
        f" WHERE NOT ({_BEARING}) AND interest_rate_apr <> 0 UNION ALL"
        " SELECT account_id, account_type, 'fee' AS broken_rule FROM bz_accounts"
        f" WHERE account_type LIKE '%{FREE_OF_FEES}%' AND monthly_maintenance_fee <> 0",
        "accounts",
    ),
    "dirt_profile": over_bronze("", "transactions") + profile_of("transactions"),
    "canonical_case": over_bronze(
        "SELECT transaction_id, account_id, coalesce(listed, spending_sector) AS spending_sector"
        f" FROM bz_transactions LEFT JOIN (VALUES {_SECTOR_ROWS}) known(listed)"
        " ON lower(listed) = lower(trim(spending_sector))",
        "transactions",
    ),
    "canonical_case_table": over_bronze(
        "SELECT customer_id, coalesce(n_name, city) AS city FROM bz_customers"
        " LEFT JOIN nation ON lower(n_name) = lower(trim(city))",
        "customers",
    ),
    "canonical_case_learned": over_bronze(
        "SELECT transaction_id, account_id, coalesce(spelling, spending_sector) AS spending_sector"
        f" FROM bz_transactions LEFT JOIN ({_LEARNED}) ON lower(spelling) = lower(trim(spending_sector))",
        "transactions",
    ),
    "learned_spellings": over_bronze(_LEARNED, "transactions"),
    "alert_rate": over_bronze(
        "SELECT a AS total_alerts, t AS total_transactions,"
        " CAST(a AS DOUBLE) / CAST(t AS DOUBLE) AS alert_rate FROM"
        " (SELECT (SELECT count(*) FROM bz_fraud_alerts) AS a,"
        " (SELECT count(*) FROM bz_transactions) AS t)",
        "fraud_alerts",
        "transactions",
    ),
    "page_overview": over_mart(
        "SELECT customer_segment, credit_risk_rating, count(*) AS customers,"
        " CAST(sum(total_accounts_owned) AS BIGINT) AS accounts,"
        " CAST(sum(total_deposit_balance) AS DECIMAL(28,2)) AS deposit_balance,"
        f" {decimal_mean('sum(dti_ratio)', 'count(dti_ratio)', 'DECIMAL(6,2)')} AS avg_dti_ratio"
        " FROM MART GROUP BY ALL",
        "mart_financial_health",
    ),
    "page_transactions": over_silver(
        "SELECT transaction_month, n AS transaction_count, v AS transaction_amount,"
        f" {mean_rounded_once('v', 'k', 'DECIMAL(28,2)')} AS amount_per_transaction,"
        " ok AS completed_count, CAST(ok AS DOUBLE) / CAST(n AS DOUBLE) AS completed_share"
        " FROM (SELECT date_trunc('month', transaction_timestamp)::TIMESTAMP AS transaction_month,"
        " count(transaction_id) AS n, count(amount) AS k, CAST(sum(amount) AS DECIMAL(28,2)) AS v,"
        " count(CASE WHEN status = 'Completed' THEN transaction_id END) AS ok"
        " FROM sv_transactions GROUP BY ALL)",
        "transactions",
    ),
    "page_loans": over_mart(
        "SELECT loan_status, CAST(sum(total_loans_count) AS BIGINT) AS loans, "
        + ", ".join(
            f"CAST(sum({total}) AS DECIMAL(28,2)) AS {name}"
            for total, name in (
                ("total_principal_borrowed", "principal_borrowed"),
                ("total_amount_repaid", "amount_repaid"),
                ("principal_repaid_component", "principal_repaid"),
                ("interest_profit_earned", "interest_earned"),
                ("total_late_fees_collected", "late_fees"),
            )
        )
        + " FROM MART GROUP BY ALL",
        "mart_loans_exact",
    ),
    "page_fraud": over_silver(
        "SELECT alert_type, n AS alerts, ok AS resolved_alerts,"
        f" {mean_rounded_once('w', 'k', 'DECIMAL(20,2)')} AS avg_risk_score, hi AS max_risk_score"
        " FROM (SELECT alert_type, count(alert_id) AS n, count(risk_score) AS k,"
        " count(CASE WHEN status = 'Resolved' THEN alert_id END) AS ok,"
        " CAST(sum(risk_score) AS DECIMAL(18,0)) AS w, max(risk_score) AS hi"
        " FROM sv_fraud_alerts GROUP BY ALL)",
        "fraud_alerts",
    ),
}
