"""The declared data checks of the staging models and marts."""

from __future__ import annotations

from bankmart.operators.quality import (
    ACCEPTED_VALUES, ERROR, NOT_NULL, RELATIONSHIPS, UNIQUE, WARN, Check,
)

_OUTCOMES = ("SUCCESS", "FAILED")

# Unique key and mandatory columns of each model.
_KEYS: dict[str, tuple[str, tuple[str, ...]]] = {
    "stg_transactions": (
        "transaction_id", ("transaction_id", "account_id", "transaction_amount", "transaction_date"),
    ),
    "stg_customers": ("customer_id", ("customer_id", "full_name")),
    "stg_accounts": ("account_id", ("account_id", "customer_id")),
    "stg_products": ("product_id", ("product_id", "product_name")),
    "dim_customer": ("customer_id", ("customer_id", "full_name")),
    "dim_account": ("account_id", ("account_id", "customer_id", "balance")),
    "dim_product": ("product_id", ("product_id", "product_name", "category_name")),
    "dim_date": ("date_key", ("date_key", "year", "month")),
    "fact_transactions": (
        "transaction_id", ("transaction_id", "account_id", "date_key", "transaction_amount"),
    ),
}

# Accepted values per model and column.
_VALUES: dict[tuple[str, str], tuple[str, ...]] = {
    ("stg_transactions", "status"): _OUTCOMES,
    ("dim_customer", "status"): ("ACTIVE", "INACTIVE", "SUSPENDED"),
    ("dim_account", "account_status"): ("OPEN", "CLOSED"),
    ("fact_transactions", "transaction_status"): _OUTCOMES,
}

# Child model and column, parent model and column, severity.
_PARENTS: tuple[tuple[str, str, str, str, str], ...] = (
    ("dim_account", "customer_id", "dim_customer", "customer_id", ERROR),
    ("fact_transactions", "account_id", "dim_account", "account_id", WARN),
    ("fact_transactions", "product_id", "dim_product", "product_id", ERROR),
    ("fact_transactions", "date_key", "dim_date", "date_key", ERROR),
)


def _declared() -> tuple[Check, ...]:
    checks: list[Check] = []
    for model, (key, mandatory) in _KEYS.items():
        checks.append(Check(model, key, UNIQUE))
        checks += [Check(model, column, NOT_NULL) for column in mandatory]
        checks += [
            Check(model, column, ACCEPTED_VALUES, values=values)
            for (owner, column), values in _VALUES.items() if owner == model
        ]
        checks += [
            Check(model, column, RELATIONSHIPS, severity, parent=parent, parent_column=parent_column)
            for child, column, parent, parent_column, severity in _PARENTS if child == model
        ]
    return tuple(checks)


CHECKS = _declared()
