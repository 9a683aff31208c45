from contactgate.functions.columns import (
    account_from_legacy,
    account_from_legacy_sql,
    can_send_rule,
    file_date_from_name,
    normalize_phone,
    normalize_phone_input,
    normalize_phone_sql,
    pad,
    parse_date,
    parse_date_sql,
    tri_state,
    tri_state_sql,
)

__all__ = [
    "account_from_legacy",
    "account_from_legacy_sql",
    "can_send_rule",
    "file_date_from_name",
    "normalize_phone",
    "normalize_phone_input",
    "normalize_phone_sql",
    "pad",
    "parse_date",
    "parse_date_sql",
    "tri_state",
    "tri_state_sql",
]
