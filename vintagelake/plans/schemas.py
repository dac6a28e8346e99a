"""Types of the published facts; the jobs write and read by these."""

from __future__ import annotations

from pyspark.sql import types as T

_DISPOSITIONS = """
    account_id bigint, product int, origin_year int, origin_month int, origin_yyyymm int, plan int,
    channel string, n_txn bigint, amount decimal(38,2), open_date date, year int, month int, obs_yyyymm int,
    vintage_offset int, mob int, mob_origin int, mob_band string, horizon string, state string,
    balance decimal(18,4), credit_limit decimal(18,2), util_ratio double, util_band string, limit_band string,
    balance_band string, level int, delinquency string, flag_30 int, flag_90 int, score int, risk_level string,
    node int, node_label string, rate decimal(18,2), rate_tier string, paper_channel string, cosecha int,
    has_balance int, opening_band string, n_addon bigint, n_primary bigint, client_uid bigint,
    int_fin decimal(38,2), int_mor decimal(38,2), int_total decimal(38,2), int_msi decimal(38,2),
    fee_amount decimal(28,2), digital_flag string, macro_segment string, write_off_flag int,
    write_off_amount decimal(38,2), write_off_rows bigint, forgiveness_flag int,
    forgiveness_amount decimal(38,2), forgiveness_rows bigint, age bigint, age_band string, sex string,
    zone_label string, brand int, store_id string, zone_raw string, totalero_flag int, segment_client string,
    write_off_horizon string, write_off_offset int, interest_horizon string, instalment_horizon string,
    load_date date
"""

_DISPOSITIONS_NET = """
    account_id bigint, product int, plan int, code int, origin_year int, origin_month int, origin_yyyymm int, channel
    string, amount decimal(38,2), n_txn bigint, open_date date, year int, month int, obs_yyyymm int, vintage_offset
    int, mob_origin int, state string, balance decimal(18,4), credit_limit decimal(18,2), util_ratio double, util_band
    string, balance_band string, level int, delinquency string, flag_30 int, flag_90 int, score int, risk_level
    string, node int, node_label string, paper_channel string, zone_label string, macro_segment string, digital_flag
    string, initial_risk string, initial_brand int, initial_state string, initial_totalero_flag int,
    initial_macro_segment string, load_date date, mob int, mob_band string, horizon string, limit_band string, rate
    decimal(18,2), rate_tier string, cosecha int, has_balance int, opening_band string, brand int, store_id string,
    totalero_flag int, n_addon bigint, n_primary bigint, client_uid bigint, int_fin decimal(38,2), int_mor
    decimal(38,2), int_total decimal(38,2), int_msi decimal(38,2), fee_amount decimal(28,2), segment_client string,
    write_off_flag int, write_off_amount decimal(38,2), write_off_rows bigint, forgiveness_flag int,
    forgiveness_amount decimal(38,2), forgiveness_rows bigint, write_off_horizon string, write_off_offset int,
    interest_horizon string, instalment_horizon string, age bigint, age_band string, sex string, zone_raw string
"""
_OVERDRAFT = """
    account_id bigint, origin_year int, origin_month int, origin_class int, overdraft_amount decimal(20,2),
    total_amount decimal(38,2), total_approved bigint, section int, year int, month int, obs_yyyymm int,
    vintage_offset int, horizon string, product int, balance decimal(18,4), credit_limit decimal(18,2), util_ratio
    double, util_band string, limit_band string, balance_band string, level int, delinquency string, cd2 int, cd2_plus
    int, mob_cd2 int, mob_origin int, level_2 string, level_3 string, node_id int, pay_max int, statement string,
    rate_tier string, vintage_text string, has_balance string, zone string, zone_id string, mob int, risk_level
    string, flag_30 string, flag_90 string, mob_band string, mob_band_numbered string, int_fin decimal(38,2), int_mor
    decimal(38,2), int_total decimal(38,2), int_msi decimal(38,2), write_off_amount decimal(38,2), write_off_count
    bigint, forgiveness_amount decimal(38,2), forgiveness_count bigint, web_flag int, digital_flag string, gender
    string, age_band string, obs_product int, state string, brand int, store_id string, headroom decimal(21,4),
    segment_client string, rfm string, macro_segment_code int, income decimal(18,3), n_addon bigint, n_primary bigint,
    zone_label string, state_code string, insured_flag int, spid string, limit_auth decimal(18,2), balance_auth
    decimal(19,2), amount_auth decimal(38,2), n_approved bigint, n_declined bigint, n_decided bigint, manual_count
    bigint, manual_amount decimal(38,2), over_limit int, closing_balance decimal(18,4), origin_yyyymm int, open_date
    date, rate decimal(18,2), rate_level string, score int, totalero_flag int, client_uid bigint, segment_year int,
    segment_month int, client_id bigint, previous_id bigint, client_open_date date, birth_date date, gender_code int,
    age int, write_off_date date, write_off_horizon string, total_label string, node_age_label string, off_flag
    string, load_date date, current_account decimal(38,9), original_account decimal(38,9), source_system int,
    last_purchase_date date, employee_number decimal(38,9), strategy_key decimal(38,9), txn_count decimal(38,9),
    track_account decimal(38,9), score_text string, client_age int, client_gender int, sex string, run_load_date int,
    open_year_band int
"""
_COHORT = """
    account_id bigint, origin_year int, origin_month int, open_store string, year int, month int, obs_yyyymm int,
    vintage_offset int, product int, state string, balance decimal(18,4), credit_limit decimal(18,2), headroom
    decimal(21,4), util_ratio double, util_band string, limit_band string, balance_band string, level int, entry_flag
    int, delinquency string, flag_30 int, flag_90 int, score int, risk_letter string, rate decimal(18,2), rate_tier
    string, zone_label string, segment_client string, rfm string, income decimal(18,3), gender string, age int,
    age_band string, digital_flag int, int_fin decimal(28,2), int_mor decimal(28,2), int_total decimal(29,2), int_msi
    decimal(28,2), write_off_amount decimal(28,2), write_off_count bigint, write_off_date date, forgiveness_amount
    decimal(28,2), forgiveness_count bigint, client_uid bigint, macro_segment_code int
"""
_LEDGER_STATE = """
    account_id bigint, product int, year int, month int, plan int, base_rows bigint, n_txn bigint, amount decimal(38,2),
    write_off_amount decimal(38,2), write_off_rows bigint, forgiveness_amount decimal(38,2), forgiveness_rows bigint,
    origin_yyyymm int
"""
_APPLICATION = "app_status string, app_status_desc string, load_date date"

# what every row of a published fact keeps to; checked in the tasks that write it
REQUIRED = {
    "dispositions": ("account_id", "origin_yyyymm", "obs_yyyymm"),
    "dispositions_net": ("account_id", "origin_yyyymm", "obs_yyyymm"),
    "overdraft": ("account_id", "origin_yyyymm", "obs_yyyymm"),
    "cohort": ("account_id", "obs_yyyymm"),
}
CHECKS = {
    "dispositions": ("obs_yyyymm >= origin_yyyymm", "vintage_offset >= 0"),
    "dispositions_net": ("obs_yyyymm >= origin_yyyymm", "vintage_offset >= 0"),
    "overdraft": ("obs_yyyymm >= origin_yyyymm", "vintage_offset >= 0", "state <> 'T'"),
    "cohort": ("vintage_offset >= 0", "state <> 'T'"),
}


def ledger_state() -> T.StructType:
    return T.StructType.fromDDL(_LEDGER_STATE)


def dispositions_net() -> T.StructType:
    return T.StructType.fromDDL(_DISPOSITIONS_NET)


def overdraft() -> T.StructType:
    return T.StructType.fromDDL(_OVERDRAFT)


def cohort(with_applications: bool = False) -> T.StructType:
    return T.StructType.fromDDL(f"{_COHORT}, {_APPLICATION}" if with_applications else _COHORT)


def dispositions() -> T.StructType:
    return T.StructType.fromDDL(_DISPOSITIONS)
