"""One DuckDB statement per registered query."""

from __future__ import annotations

from claimtide.oracle import relations as R

_DIMENSIONS = (
    "claim_number transaction_month lob cob_name cob_group cob_grouping channel state coverage "
    "ay py ry ay_age py_age ry_age am_age loss_cause_type_name paygo_indicator "
    "indemnity_medicalonly current_appetite attorney_represented litigated "
    "food_and_bev_express_ind agency_type renewal_tag bop_policy_flag"
).split()


def _money(sql: str) -> str:
    return f"CAST({sql} AS DECIMAL(38,4))"


def _count(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


def _rows_where(condition: str) -> str:
    return _count(f"count(*) FILTER (WHERE {condition})")


def _sum_where(amount: str, condition: str) -> str:
    return _money(f"ifnull(sum({amount}) FILTER (WHERE {condition}), 0)")


_OPEN = "case_lossandalae > 0"
_CLOSED = "case_lossandalae <= 0"
_WITH_PAY = f"{_CLOSED} AND paid_loss > 0"
_NO_PAY = f"{_CLOSED} AND paid_loss = 0"


def _result_measures(caps: dict[str, int] | dict[str, str] = R.CAPS) -> dict[str, str]:
    """The 97 claim measures over claim-level rows."""
    measures = {
        "open_cc": _rows_where(_OPEN),
        "closed_cc": _rows_where(_CLOSED),
        "cwp_cc": _rows_where(_WITH_PAY),
        "cnp_cc": _rows_where(_NO_PAY),
        "closed_expenseonly_cc": _rows_where(f"{_NO_PAY} AND paid_alae > 0"),
        "closed_nolossorexpense_cc": _rows_where(f"{_NO_PAY} AND paid_alae = 0"),
        "reported_cc": _count("count(*)"),
        "nonzero_reported_cc": _rows_where("reported_loss > 0"),
        "expenseonly_cc": _rows_where("reported_loss = 0 AND reported_alae > 0"),
        "litigated_claim_count": _count("sum(in_suit_flag)"),
        "attorney_rep_claim_count": _count("sum(attorney_rep_flag)"),
        "litigated_nonzero_claim_count": _rows_where("in_suit_flag = 1 AND reported_loss > 0"),
        "attorney_nonzero_claim_count":
            _rows_where("attorney_rep_flag = 1 AND reported_loss > 0"),
    }
    for plain in (
        "paid_alae reported_alae paid_loss_ss reported_loss_ss reported_lossandalae_ss "
        "paid_lossandalae_ss case_lossandalae total_ss total_incurred_xss reported_loss case_loss"
    ).split():
        measures[plain] = _money(f"sum({plain})")
    for amount in ("reported_loss_ss", "reported_lossandalae_ss"):
        measures[f"nonzero_{amount}"] = _sum_where(amount, "reported_loss > 0")
    for level, cap in caps.items():
        measures[f"ll_{level}_cc"] = _rows_where(f"reported_lossandalae_ss > {cap}")

    reported, paid = "reported_lossandalae_ss", "paid_lossandalae_ss"
    families = [
        ("paid_lossalaess_on_closed", _WITH_PAY, paid, None),
        ("paid_lossss_on_closed", _WITH_PAY, "paid_loss_ss", None),
        ("reported_lossalaess_on_open", _OPEN, reported, None),
        ("case_lossalae_on_open", _OPEN, reported, paid),
        ("paid_lossalaess_on_open", _OPEN, paid, None),
        ("reported_lossss_on_open", _OPEN, "reported_loss_ss", None),
        ("case_loss_on_open", _OPEN, "reported_loss_ss", "paid_loss_ss"),
        ("paid_lossss_on_open", _OPEN, "paid_loss_ss", None),
    ]
    for name, condition, plus, minus in families:
        whole = plus if minus is None else f"{plus} - {minus}"
        spelled = "reported_lossalaessss_on_open" if plus == reported and minus is None else name
        measures[spelled] = _sum_where(whole, condition)
        for level, cap in caps.items():
            at_most = f"least({plus}, {cap})"
            if minus is not None:
                at_most += f" - least({minus}, {cap})"
            measures[f"{name}_capped_{level}"] = _sum_where(at_most, condition)
    return measures


# A second set of limits, of the query `cross_join_caps` alone.
_OTHER_CAPS = {"low": 12_345, "mid": 60_000, "high": 2_500_000}

# And a third one, of rows of a table.
_REGION_CAPS = {
    level: f"(SELECT (r_regionkey + 1) * 15000 FROM region WHERE r_name = '{name}')"
    for level, name in {"first": "AFRICA", "third": "ASIA"}.items()
}

_MEASURES = _result_measures()
_COUNTS = [m for m in _MEASURES if m.endswith(("_cc", "_count"))]


def _named(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _claims() -> str:
    empty = {
        "earned_premium": "CAST(NULL AS DECIMAL(38,4))",
        "earned_policy_years": "CAST(NULL AS DOUBLE)",
    }
    return f"""SELECT {", ".join(_DIMENSIONS)}, {_named({**empty, **_MEASURES})}
               FROM level GROUP BY {", ".join(_DIMENSIONS)}"""


def _premium() -> str:
    year = "CAST(year(transaction_month) AS INTEGER)"
    month = "CAST(month(transaction_month) AS INTEGER)"
    special = {
        "claim_number": "''", "cob_grouping": R.COB_GROUPING, "bop_policy_flag": R.BOP,
        "ay": year, "ry": year, "ay_age": month, "ry_age": month, "am_age": month,
        "py": "CAST(year(policy_start_date) AS INTEGER)",
        **{c: "'N/A'" for c in (
            "loss_cause_type_name", "indemnity_medicalonly", "current_appetite",
            "attorney_represented", "litigated")},
    }
    sums = {
        "earned_premium": _money("sum(earned_premium)"),
        "earned_policy_years": "CAST(sum(earned_days) AS DOUBLE) / 365.0",
    }
    zeros = {m: _count("0") if m in _COUNTS else _money("0") for m in _MEASURES}
    keys = ", ".join(f"{special.get(d, d)} AS {d}" for d in _DIMENSIONS)
    return f"SELECT {keys}, {_named({**sums, **zeros})} FROM earning GROUP BY ALL"


def _result() -> str:
    sums = {"earned_premium": _money("sum(u.earned_premium)"),
            "earned_policy_years": "sum(u.earned_policy_years)"}
    sums |= {m: (_count if m in _COUNTS else _money)(f"sum(u.{m})") for m in _MEASURES}
    dims = ", ".join(f"u.{d}" for d in _DIMENSIONS)
    return f"""SELECT {dims}, {_named(sums)}
               FROM (SELECT * FROM ({_claims()})
                     UNION ALL BY NAME SELECT * FROM ({_premium()})) AS u
               GROUP BY {dims}"""


def _per_year_and_lob(columns: dict[str, str]) -> str:
    return f"SELECT ay, lob, {_named(columns)} FROM level GROUP BY ay, lob"


def _level_sums(names: str) -> str:
    return _per_year_and_lob({m: _money(f"sum({m})") for m in names.split()})


def _measures(names: list[str]) -> str:
    return _per_year_and_lob({m: _MEASURES[m] for m in names})


_N = {"n_rows": _count("count(*)")}
_N_SQL = _named(_N)


def _capped_case(reported: str, paid: str, name: str) -> dict[str, str]:
    return {
        f"capped_{level}_{name}": _money(f"sum(least({reported}, {cap}) - least({paid}, {cap}))")
        for level, cap in R.CAPS.items()
    }


def _bodies() -> dict[str, str]:
    level_columns = (
        "policy_reference claim_number lob cob_name cob_group cob_grouping channel "
        "paygo_indicator state loss_cause_type_name accident_month ay py ry ay_age py_age ry_age "
        "am_age transaction_month coverage in_suit_flag attorney_rep_flag "
        "food_and_bev_express_ind agency_type renewal_tag bop_policy_flag"
    ).split()
    level_amounts = [*R.LEVEL_SUMS, "case_lossandalae", "case_loss"]
    limited = ["reported_lossandalae_ss", "paid_lossandalae_ss", "reported_loss_ss", "paid_loss_ss"]
    reported_lobs = f"lrd WHERE lob IN ({R.LOBS})"
    claim_rows = f"{reported_lobs} AND ay_age > 0 AND claim_number IS NOT NULL"
    result = _result()
    bodies = {
        "scan_lrd": "SELECT * FROM lrd",
        "scan_fin_changes": "SELECT * FROM fin",
        "scan_legal_scd": """SELECT exposure_id, legal_status,
            strftime(start_datetime, '%Y-%m-%d %H:%M:%S') AS start_datetime,
            strftime(end_datetime, '%Y-%m-%d %H:%M:%S') AS end_datetime FROM scd""",
        "cap_inputs": "SELECT lob, " + _N_SQL + ", " + ", ".join(
            f"CAST({cap} AS DOUBLE) AS cap_{level}" for level, cap in R.CAPS.items()
        ) + f" FROM {reported_lobs} GROUP BY lob",
        "publish_roundtrip": result,
        "filter_lob": f"""SELECT lob, coverage, {_N_SQL},
            {_money("sum(earned_premium)")} AS earned_premium FROM {reported_lobs} GROUP BY ALL""",
        "filter_claim_rows": f"""SELECT lob, ay_age, {_N_SQL},
            {_money("sum(incurred_loss)")} AS incurred_loss FROM {claim_rows} GROUP BY ALL""",
        "scd_interval_join":
            "SELECT claim_number, exposure_id, date, legal_status FROM status_of_change",
        "legal_month_end": "SELECT * FROM month_end_status",
        "legal_flags_by_claim_month": "SELECT * FROM legal",
        "legal_status_flags": f"""SELECT legal_status, attorney_rep_flag, in_suit_flag, {_N_SQL}
            FROM status_of_change GROUP BY ALL""",
        "join_legal_flags": f"""SELECT lob, transaction_month,
            ifnull(in_suit_flag, 0) AS in_suit_flag,
            ifnull(attorney_rep_flag, 0) AS attorney_rep_flag, {_N_SQL}
            FROM (SELECT * FROM {claim_rows}) LEFT JOIN legal
            USING (claim_number, transaction_month) GROUP BY ALL""",
        "latest_agency": "SELECT policy_reference, agency_type FROM agency",
        "join_latest_agency": f"""SELECT lob, agency.agency_type, {_N_SQL}
            FROM lrd LEFT JOIN agency USING (policy_reference) GROUP BY ALL""",
        "incurred_by_cause": f"""SELECT claim_number, loss_cause_type_name, transaction_month,
            {_money("total_incurred")} AS total_incurred FROM by_cause""",
        "dominant_loss_cause": "SELECT claim_number, loss_cause_type_name FROM cause",
        "join_dominant_cause": f"""SELECT lob, cause.loss_cause_type_name, {_N_SQL}
            FROM (SELECT * FROM {claim_rows}) LEFT JOIN cause USING (claim_number) GROUP BY ALL""",
        "cob_grouping": f"""SELECT cob_group, cob_name, {R.COB_GROUPING} AS cob_grouping, {_N_SQL}
            FROM lrd GROUP BY ALL""",
        "channel_normalised": f"""SELECT agency.agency_type, lrd.channel AS raw_channel,
            {R.channel("agency.agency_type", "lrd.channel")} AS channel, {_N_SQL}
            FROM lrd LEFT JOIN agency USING (policy_reference) GROUP BY ALL""",
        "ry_age_repair": f"""SELECT ry_age AS raw_ry_age, ay_age, {R.RY_AGE} AS ry_age, {_N_SQL}
            FROM lrd GROUP BY lrd.ry_age, lrd.ay_age""",
        "bop_policy_flag": f"""SELECT is_bop_policy, {R.BOP} AS bop_policy_flag, {_N_SQL}
            FROM lrd GROUP BY ALL""",
        "development_axes_claims": f"""SELECT CAST(year(accident_month) AS INTEGER) AS ay,
            CAST(year(policy_start_date) AS INTEGER) AS py,
            CAST(year(report_month) AS INTEGER) AS ry, {_N_SQL} FROM {claim_rows} GROUP BY ALL""",
        "development_axes_premium": f"""SELECT transaction_month,
            CAST(year(policy_start_date) AS INTEGER) AS py, py_age, {_N_SQL},
            CAST(year(transaction_month) AS INTEGER) AS ay,
            CAST(year(transaction_month) AS INTEGER) AS ry,
            CAST(month(transaction_month) AS INTEGER) AS ay_age,
            CAST(month(transaction_month) AS INTEGER) AS ry_age,
            CAST(month(transaction_month) AS INTEGER) AS am_age
            FROM {reported_lobs} GROUP BY ALL""",
        "claim_level": f"""SELECT {", ".join(level_columns)},
            {_named({m: _money(m) for m in level_amounts})} FROM level""",
        "net_loss_measures": _level_sums(" ".join(limited)),
        "alae_measures": _level_sums("paid_alae reported_alae"),
        "case_reserves": _level_sums("case_lossandalae case_loss"),
        "gross_loss_measures": _level_sums(
            "paid_loss reported_loss paid_dcce paid_aoe reported_dcce reported_aoe "
            "reported_indemnity_loss reported_medical_loss total_ss total_incurred_xss"),
        "cross_join_caps": _per_year_and_lob({
            name: sql for name, sql in _result_measures(_OTHER_CAPS).items()
            if name.startswith("ll_") or name.startswith(
                ("paid_lossalaess_on_closed_capped", "case_lossalae_on_open_capped"))}),
        "caps_from_a_table": _per_year_and_lob({
            name: sql for name, sql in _result_measures(_REGION_CAPS).items()
            if name.startswith(("ll_", "case_lossalae_on_open_capped"))}),
        "cap_ladder": _per_year_and_lob({
            f"capped_{level}_{amount}": _money(f"sum(least({amount}, {cap}))")
            for amount in limited for level, cap in R.CAPS.items()}),
        "capped_case": _per_year_and_lob({
            **_capped_case(limited[0], limited[1], "case_lossandalae"),
            **_capped_case(limited[2], limited[3], "case_loss")}),
        "large_loss_counts": _measures([f"ll_{level}_cc" for level in R.CAPS]),
        "open_closed_status": _measures(
            ["open_cc", "closed_cc", "cwp_cc", "cnp_cc", "closed_expenseonly_cc",
             "closed_nolossorexpense_cc"]),
        "claim_counts": _measures(
            ["reported_cc", "nonzero_reported_cc", "expenseonly_cc", "litigated_claim_count",
             "attorney_rep_claim_count"]),
        "nonzero_amounts": _measures(
            ["nonzero_reported_loss_ss", "nonzero_reported_lossandalae_ss"]),
        "legal_nonzero_counts": _measures(
            ["litigated_nonzero_claim_count", "attorney_nonzero_claim_count"]),
        "paid_on_closed": _measures([m for m in _MEASURES if "_on_closed" in m]),
        "amounts_on_open": _measures([m for m in _MEASURES if "_on_open" in m]),
        "legal_labels": f"""SELECT ay, in_suit_flag, attorney_rep_flag, litigated,
            attorney_represented, {_N_SQL} FROM level GROUP BY ALL""",
        "wc_injury_type":
            f"SELECT ay, lob, indemnity_medicalonly, {_N_SQL} FROM level GROUP BY ALL",
        "wc_appetite":
            f"SELECT lob, cob_name, current_appetite, {_N_SQL} FROM level GROUP BY ALL",
        "earned_exposure_cumulative": f"""SELECT policy_reference, transaction_month,
            policy_start_date, policy_end_date, CAST(cumulative_days AS INTEGER)
            AS cumulative_days, {_N_SQL} FROM exposure GROUP BY ALL""",
        "earned_exposure_incremental": f"""SELECT policy_reference, transaction_month, lob,
            coverage, {_count("sum(earned_days)")} AS earned_days,
            {_money("sum(earned_premium)")} AS earned_premium FROM earning GROUP BY ALL""",
        "scalar_dates": f"""SELECT date, {_N_SQL},
            CAST(date_trunc('month', date) AS DATE) AS month_start,
            CAST(date - INTERVAL 1 DAY AS DATE) AS day_before, last_day(date) AS month_end,
            CAST(datediff('day', date, last_day(date)) AS INTEGER) AS days_to_month_end,
            CAST(year(date) AS INTEGER) AS year_of, CAST(month(date) AS INTEGER) AS month_of
            FROM fin GROUP BY ALL""",
        "scalar_conditional": f"""SELECT lob,
            CASE WHEN incurred_loss IS NULL THEN 'unknown' WHEN incurred_loss <= 0 THEN 'none'
                 WHEN paid_loss > 0 THEN 'paid' ELSE 'case' END AS loss_kind, {_N_SQL},
            {_money("sum(ifnull(paid_loss, 0) + ifnull(paid_subro, 0) + ifnull(paid_salvage, 0))")}
                AS paid_net,
            CAST(sum(datediff('day', policy_start_date, policy_end_date)) AS DOUBLE) / 365.0
                AS term_years
            FROM lrd GROUP BY ALL""",
        "claims_branch": _claims(),
        "premium_branch": _premium(),
        "branch_union": f"""SELECT CASE WHEN claim_number = '' THEN 'premium' ELSE 'claims' END
            AS branch, lob, litigated, {_N_SQL}, {", ".join(
                f"{_count(f'count({m})')} AS n_{m}" for m in (
                    "earned_premium", "earned_policy_years", "reported_cc", "reported_loss",
                    "paid_lossandalae_ss"))}
            FROM ({result}) GROUP BY ALL""",
        "emergence_full": result,
        "final_rollup": result,
        "ordered_output": f"""SELECT * FROM ({result})
            ORDER BY ay, py, ry, ay_age, py_age, ry_age, lob, bop_policy_flag""",
    }
    return bodies


def oracle_sql() -> dict[str, str]:
    return {name: f"{R.ALL}\n{body}" for name, body in _bodies().items()}
