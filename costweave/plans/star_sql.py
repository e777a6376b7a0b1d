"""SQL twins of the star-schema frames, for checking results in another engine.

Each entry is a common table expression; ``twin`` strings together the ones a
query needs. Rounding happens at the same points as in the Spark operators:
money is kept to six decimals, results are shown to two.
"""

from __future__ import annotations

import re

from costweave import constants as K
from costweave.sources import star as S


def q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def rows(values) -> str:
    return ", ".join("(" + ", ".join(v if isinstance(v, str) else str(v) for v in row) + ")" for row in values)


def money(expr: str) -> str:
    """Six-decimal money from a double or decimal expression."""
    return f"CAST({expr} AS DECIMAL(19,6))"


def shown(expr: str, places: int = 2) -> str:
    """A decimal rounded for output."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,6)), {places}) AS DOUBLE)"


def ratio(num: str, den: str, places: int = 6) -> str:
    return (
        f"ROUND(CASE WHEN {den} <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END, {places})"
        " + CAST(0 AS DOUBLE)"
    )


def n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def d(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR)"


_SEGMENTS = " ".join(f"WHEN {q(s)} THEN {q(g)}" for s, g in S.SEGMENT_GROUPS.items())
_OVERHEAD = ", ".join(str(i) for i, p in enumerate(S.NATION_POOLS) if p == "OVERHEAD")
_POOLS = "[" + ", ".join(q(p) for p in S.NATION_POOLS) + "]"
_CARE = (
    "CASE WHEN o_orderstatus = 'O' THEN 'Outpatient' WHEN o_orderstatus = 'P' THEN 'Emergency' "
    "WHEN o_orderkey % 4 = 0 THEN 'Same-day' ELSE 'Inpatient' END"
)
_MEASURES = list(K.MEASURE_POOLS)
_ADJUST = {
    "INDIGENOUS": "indigenous_status = 'Y'",
    "REMOTE": "remoteness_area = 'Remote'",
    "PAEDIATRIC": "age_years < 18 AND service_stream = 'Admitted acute'",
    "SAME_DAY": "care_type = 'Same-day' AND activity_group_code = 'AG04'",
}
_FACTOR = " * ".join(
    f"CASE WHEN {cond} THEN CAST({K.ADJUSTMENT_FACTORS[code]} AS DECIMAL(3,2)) ELSE CAST(1 AS DECIMAL(3,2)) END"
    for code, cond in _ADJUST.items()
)
_BAD = S.BAD_STEP


def _text(column: str, spoiled: str | None = None) -> str:
    value = f"' ' || CAST({column} AS VARCHAR) || ' '"
    return f"CASE WHEN {spoiled} THEN 'bad' ELSE {value} END" if spoiled else value


CTE = {
    "enc": f"""
        SELECT CAST(1 AS BIGINT) AS load_run_id, CAST(o_orderkey AS VARCHAR) AS encounter_id,
               CAST(o_custkey AS VARCHAR) AS patient_id, r_name AS facility,
               o_orderpriority AS service_line, {_CARE} AS care_type,
               CAST(o_orderdate AS DATE) AS admission_date,
               CAST(o_orderdate AS DATE) + CAST(CASE WHEN {_CARE} = 'Inpatient' THEN o_orderkey % 15 ELSE 0 END AS INTEGER) AS discharge_date,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS episode_month,
               CASE c_mktsegment {_SEGMENTS} END AS activity_group_code,
               CASE WHEN {_CARE} = 'Inpatient' THEN o_orderkey % 15 ELSE 0 END AS length_of_stay,
               'Discharged' AS separation_status,
               o_custkey % 90 AS age_years,
               CASE WHEN o_custkey % 29 = 0 THEN 'Y' ELSE 'N' END AS indigenous_status,
               CASE WHEN o_custkey % 41 = 0 THEN 'Remote' ELSE 'Major Cities' END AS remoteness_area,
               CASE WHEN o_orderkey % 7 = 0 THEN 'Y' ELSE 'N' END AS high_complexity_flag,
               CASE WHEN o_orderkey % 50 = 0 THEN 'Y' ELSE 'N' END AS hospital_acquired_complication_flag,
               o_orderkey AS k
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "res": f"""
        SELECT CAST(1 AS BIGINT) AS load_run_id,
               CAST(o_orderkey AS VARCHAR) || '-' || CAST(l_linenumber % 2 AS VARCHAR) AS resource_usage_id,
               CAST(o_orderkey AS VARCHAR) AS encounter_id,
               CAST(date_trunc('month', o_orderdate) + to_months(CAST(l_linenumber % 2 AS INTEGER)) AS DATE) AS service_month,
               CASE WHEN {_CARE} IN ('Inpatient', 'Same-day') THEN COUNT(*) ELSE 0 END AS bed_days,
               SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS theatre_minutes,
               SUM(l_linenumber) AS imaging_weighted_units,
               SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS pathology_weighted_units,
               SUM(CAST(l_quantity AS BIGINT)) AS pharmacy_units,
               COUNT(*) AS medical_service_units,
               SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS allied_health_units,
               o_orderkey AS k
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_orderkey, l_linenumber % 2, o_orderstatus, o_orderdate""",
    "line": f"""
        SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
               'CC_' || CAST(s_nationkey AS VARCHAR) AS cost_centre_id,
               CASE WHEN s_nationkey % {len(S.NATION_POOLS)} IN ({_OVERHEAD}) THEN 'OH'
                    WHEN s_nationkey IN ({S.UNMAPPED_NATION}, {S.EXPIRED_NATION}) AND l_returnflag || l_linestatus = {q(S.DIRECT_ACCOUNT)}
                    THEN {q(S.UNMAPPED_DIRECT_ACCOUNT)}
                    ELSE l_returnflag || l_linestatus END AS natural_account,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
               {money("l_extendedprice * (1 - l_discount)")} AS amount
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "gl": f"""
        SELECT CAST(1 AS BIGINT) AS load_run_id,
               CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS gl_transaction_id,
               month AS reporting_month, 'Health Service' AS entity, {q(S.FACILITY)} AS facility,
               cost_centre_id, natural_account, 'Account ' || natural_account AS account_description,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -amount ELSE amount END AS signed_amount,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'Credit' ELSE 'Standard expense' END AS adjustment_type,
               CASE WHEN natural_account = 'AF' THEN 'DIRECT-CONTROL-' ELSE 'MONTHLY-' END
                 || CAST(month AS VARCHAR) || '-' || cost_centre_id || '-' || natural_account AS source_reference,
               l_orderkey AS k
        FROM line""",
    "dir": """
        SELECT CAST(1 AS BIGINT) AS load_run_id,
               CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS direct_cost_id,
               CAST(CASE WHEN l_linenumber = 7 THEN -1 - l_orderkey ELSE l_orderkey END AS VARCHAR) AS encounter_id,
               month AS service_month, cost_centre_id, natural_account,
               'Patient-specific item' AS direct_cost_type,
               CAST(l_quantity AS BIGINT) AS quantity, amount
        FROM line WHERE natural_account = 'AF'""",
    "dok": "SELECT * FROM dir WHERE encounter_id IN (SELECT encounter_id FROM enc)",
    "dbad": "SELECT * FROM dir WHERE encounter_id NOT IN (SELECT encounter_id FROM enc)",
    "centre": f"""
        SELECT 'CC_' || CAST(n_nationkey AS VARCHAR) AS cost_centre_id, n_name AS cost_centre_name,
               {_POOLS}[CAST(n_nationkey % {len(S.NATION_POOLS)} + 1 AS BIGINT)] AS cost_pool_code, 'Y' AS active_flag,
               DATE '{S.OPEN_FROM}' AS effective_from,
               CASE n_nationkey WHEN {S.SPLIT_NATION} THEN DATE '{S.SPLIT_END}'
                    WHEN {S.EXPIRED_NATION} THEN DATE '{S.EXPIRED_END}' ELSE DATE '{S.OPEN_TO}' END AS effective_to
        FROM nation WHERE n_nationkey <> {S.UNMAPPED_NATION}
        UNION ALL
        SELECT 'CC_' || CAST(n_nationkey AS VARCHAR), n_name, {q(S.SPLIT_POOL)},
               CASE n_nationkey WHEN {S.SPLIT_NATION} THEN 'Y' ELSE 'N' END,
               CASE n_nationkey WHEN {S.SPLIT_NATION} THEN DATE '{S.SPLIT_START}' ELSE DATE '{S.OPEN_FROM}' END,
               DATE '{S.OPEN_TO}'
        FROM nation WHERE n_nationkey IN ({S.SPLIT_NATION}, {S.INACTIVE_NATION})""",
    "account": f"""
        SELECT * FROM (VALUES {rows([tuple(q(v) for v in a) for a in S.ACCOUNTS])})
          AS t(natural_account, account_description, cost_category, costing_treatment, default_driver, active_flag)""",
    "rule": f"""
        SELECT 'RULE_' || cost_pool_code || '_' || cost_category AS allocation_rule_id, cost_pool_code,
               cost_category, allocation_driver, eligible_scope, DATE '{S.OPEN_FROM}' AS effective_from,
               CAST(effective_to AS DATE) AS effective_to
        FROM (VALUES {rows([tuple(q(v) for v in r) for r in S.rule_rows()])})
          AS t(cost_pool_code, cost_category, allocation_driver, eligible_scope, effective_to)""",
    "mapped": """
        SELECT gl.*, c.cost_pool_code, a.cost_category, a.costing_treatment, a.default_driver,
               r.allocation_driver, c.cost_centre_id IS NOT NULL AS centre_found,
               a.natural_account IS NOT NULL AS account_found
        FROM gl
        LEFT JOIN centre c ON c.cost_centre_id = gl.cost_centre_id AND c.active_flag = 'Y'
             AND gl.reporting_month BETWEEN c.effective_from AND c.effective_to
        LEFT JOIN account a ON a.natural_account = gl.natural_account
        LEFT JOIN rule r ON r.cost_pool_code = c.cost_pool_code AND r.cost_category = a.cost_category
             AND gl.reporting_month BETWEEN r.effective_from AND r.effective_to""",
    "pool": f"""
        SELECT load_run_id, reporting_month, facility, cost_centre_id, natural_account,
               COALESCE(cost_pool_code, 'UNMAPPED') AS cost_pool_code,
               COALESCE(cost_category, 'Unmapped') AS cost_category,
               COALESCE(costing_treatment, 'Review') AS costing_treatment,
               COALESCE(allocation_driver, default_driver, 'review') AS allocation_driver,
               COUNT(*) AS source_transaction_count, {money("SUM(signed_amount)")} AS source_gl_amount,
               CASE WHEN NOT centre_found OR NOT account_found THEN 'REVIEW'
                    WHEN COALESCE(costing_treatment, 'Review') = 'Exclude' THEN 'EXCLUDED' ELSE 'READY' END AS pool_status,
               CASE WHEN NOT centre_found THEN {q(K.NOTE_NO_CENTRE)} WHEN NOT account_found THEN {q(K.NOTE_NO_ACCOUNT)}
                    WHEN COALESCE(costing_treatment, 'Review') = 'Exclude' THEN {q(K.NOTE_EXCLUDED)} END AS review_note
        FROM mapped GROUP BY ALL""",
    "drv": " UNION ALL ".join(
        f"""SELECT load_run_id, service_month AS reporting_month, encounter_id, {q(pool)} AS cost_pool_code,
            {q(m)} AS allocation_driver, CAST({m} AS DECIMAL(19,6)) AS driver_units FROM res"""
        for m, pool in K.MEASURE_POOLS.items()
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"""SELECT load_run_id, episode_month, encounter_id, {q(pool)}, 'encounter_count', CAST(1 AS DECIMAL(19,6))
            FROM enc {'' if care is None else 'WHERE care_type = ' + q(care)}"""
        for pool, care in K.COUNT_POOLS.items()
    ),
    "tot": """
        SELECT load_run_id, reporting_month, cost_pool_code, allocation_driver, SUM(driver_units) AS total_driver_units
        FROM drv WHERE driver_units > 0 GROUP BY ALL""",
    "rate": """
        SELECT p.load_run_id, p.reporting_month, p.facility, p.cost_centre_id, p.natural_account, p.cost_pool_code,
               p.allocation_driver, p.source_gl_amount, t.total_driver_units,
               CAST(p.source_gl_amount AS DOUBLE) / CAST(t.total_driver_units AS DOUBLE) AS rate
        FROM pool p JOIN tot t USING (load_run_id, reporting_month, cost_pool_code, allocation_driver)
        WHERE p.pool_status = 'READY' AND p.costing_treatment = 'Indirect'""",
    "krate": """
        SELECT load_run_id, reporting_month, cost_pool_code, allocation_driver, SUM(rate) AS rate FROM rate GROUP BY ALL""",
    "alloc": f"""
        SELECT load_run_id, reporting_month, encounter_id, cost_pool_code, allocation_driver, driver_units,
               {money("CAST(driver_units AS DOUBLE) * rate")} AS allocated_amount
        FROM drv JOIN krate USING (load_run_id, reporting_month, cost_pool_code, allocation_driver)
        WHERE driver_units > 0""",
    "ind": """
        SELECT load_run_id, reporting_month, encounter_id, SUM(allocated_amount) AS allocated_amount
        FROM alloc GROUP BY ALL""",
    "dsum": """
        SELECT load_run_id, service_month AS reporting_month, encounter_id, SUM(amount) AS assigned_amount
        FROM dok GROUP BY ALL""",
    "base": """
        SELECT e.*, e.episode_month AS reporting_month, COALESCE(x.assigned_amount, 0) AS direct_cost_amount,
               COALESCE(i.allocated_amount, 0) AS indirect_cost_amount,
               COALESCE(x.assigned_amount, 0) + COALESCE(i.allocated_amount, 0) AS pre
        FROM enc e
        LEFT JOIN dsum x ON x.encounter_id = e.encounter_id AND x.reporting_month = e.episode_month
        LEFT JOIN ind i ON i.encounter_id = e.encounter_id AND i.reporting_month = e.episode_month""",
    "base_all": """
        SELECT e.*, e.episode_month AS reporting_month, COALESCE(x.a, 0) AS direct_cost_amount,
               COALESCE(i.a, 0) AS indirect_cost_amount, COALESCE(x.a, 0) + COALESCE(i.a, 0) AS pre
        FROM enc e
        LEFT JOIN (SELECT encounter_id, SUM(assigned_amount) AS a FROM dsum GROUP BY 1) x USING (encounter_id)
        LEFT JOIN (SELECT encounter_id, SUM(allocated_amount) AS a FROM ind GROUP BY 1) i USING (encounter_id)""",
}


def _overhead(base: str, suffix: str) -> None:
    CTE[f"otot{suffix}"] = f"""
        SELECT load_run_id, reporting_month, SUM(pre) AS total FROM {base} WHERE pre > 0 GROUP BY ALL"""
    CTE[f"orate{suffix}"] = f"""
        SELECT p.*, t.total AS total_driver_units, CAST(p.source_gl_amount AS DOUBLE) / CAST(t.total AS DOUBLE) AS rate
        FROM pool p JOIN otot{suffix} t USING (load_run_id, reporting_month)
        WHERE p.pool_status = 'READY' AND p.costing_treatment = 'Overhead'
          AND p.cost_pool_code = 'OVERHEAD' AND p.allocation_driver = 'pre_overhead_cost'"""
    CTE[f"cost{suffix}"] = f"""
        SELECT b.*, COALESCE({money("CASE WHEN pre > 0 THEN CAST(pre AS DOUBLE) * o.rate END")}, 0) AS overhead_cost_amount,
               {money(f"b.pre + COALESCE({money('CASE WHEN pre > 0 THEN CAST(pre AS DOUBLE) * o.rate END')}, 0)")} AS total_patient_cost
        FROM {base} b
        LEFT JOIN (SELECT load_run_id, reporting_month, SUM(rate) AS rate FROM orate{suffix} GROUP BY ALL) o
          USING (load_run_id, reporting_month)"""


_overhead("base", "")
_overhead("base_all", "_all")

CTE.update(
    {
        "lim": """
        SELECT care_type, activity_group_code, COUNT(*) AS cohort_count,
               quantile_cont(CAST(total_patient_cost AS DOUBLE), 0.95) AS p
        FROM cost GROUP BY ALL""",
        "flagged": f"""
        SELECT c.*, CASE WHEN cohort_count >= {K.MIN_COHORT} AND CAST(total_patient_cost AS DOUBLE) >= p THEN 'Y' ELSE 'N' END AS high_cost_flag,
               CASE WHEN cohort_count < {K.MIN_COHORT} THEN {q(K.NOTE_SMALL_COHORT.format(n=K.MIN_COHORT))}
                    WHEN CAST(total_patient_cost AS DOUBLE) >= p THEN {q(K.NOTE_HIGH_COST)} || CAST(cohort_count AS VARCHAR)
                      || '; p95=' || CAST(CAST(p AS DECIMAL(19,2)) AS VARCHAR) END AS review_note
        FROM cost c JOIN lim USING (care_type, activity_group_code)""",
        "grp": f"""
        SELECT activity_group_code, service_stream, CAST(weight AS DECIMAL(8,4)) AS weight, trim_days,
               CAST(outlier AS DECIMAL(8,4)) AS outlier
        FROM (VALUES {rows([(q(g[0]), q(g[2]), g[3], g[4], g[5]) for g in S.FUNDING_GROUPS])})
          AS t(activity_group_code, service_stream, weight, trim_days, outlier)""",
        "weighted": f"""
        SELECT c.*, g.service_stream, g.weight, g.activity_group_code IS NOT NULL AS funded,
               CASE WHEN g.activity_group_code IS NOT NULL THEN {_FACTOR} END AS factor,
               greatest(0, length_of_stay - trim_days) AS long_days,
               CAST(greatest(0, length_of_stay - trim_days) AS DECIMAL(6,0)) * outlier AS outlier_nwau
        FROM cost c LEFT JOIN grp g USING (activity_group_code)""",
        "cmp": f"""
        SELECT *, {money("weight * factor + outlier_nwau")} AS synthetic_nwau,
               {money(f"{money('weight * factor + outlier_nwau')} * {K.BASE_PRICE.normalize():f}")} AS synthetic_funding_amount,
               CASE WHEN funded THEN 'FUNDED' ELSE 'UNFUNDED_REVIEW' END AS funding_status
        FROM weighted""",
        "fund": f"""
        SELECT w.load_run_id, w.encounter_id, w.episode_month, w.activity_group_code, w.service_stream, w.weight AS base_weight,
               CAST(factor AS DECIMAL(12,6)) AS demographic_adjustment_factor,
               {money("outlier_nwau")} AS long_stay_outlier_nwau,
               {money("weight * factor + outlier_nwau")} AS final_synthetic_nwau,
               CAST((weight * factor + outlier_nwau) * 10750 AS DECIMAL(19,2)) AS estimated_synthetic_funding,
               CASE WHEN funded THEN 'CALCULATED' ELSE 'UNFUNDED_REVIEW' END AS funding_status,
               CASE WHEN NOT funded THEN {q(K.NOTE_UNSUPPORTED_GROUP)} ELSE COALESCE(NULLIF(concat_ws('; ',
                 {", ".join(f"CASE WHEN {c} THEN {q(K.ADJUSTMENT_NOTES[k])} END" for k, c in _ADJUST.items())},
                 CASE WHEN long_days > 0 THEN 'Synthetic long-stay outlier: ' || CAST(long_days AS VARCHAR) || ' days' END), ''),
                 {q(K.NOTE_BASE_WEIGHT_ONLY)}) END AS funding_note
        FROM (SELECT e.*, g.service_stream, g.weight, g.activity_group_code IS NOT NULL AS funded,
                     CASE WHEN g.activity_group_code IS NOT NULL THEN {_FACTOR} END AS factor,
                     CASE WHEN g.activity_group_code IS NOT NULL THEN greatest(0, length_of_stay - trim_days) END AS long_days,
                     CASE WHEN g.activity_group_code IS NOT NULL THEN CAST(greatest(0, length_of_stay - trim_days) AS DECIMAL(6,0)) * outlier END AS outlier_nwau
              FROM enc e LEFT JOIN grp g USING (activity_group_code)) w""",
        "zero": """
        SELECT p.* FROM pool p LEFT JOIN tot t USING (load_run_id, reporting_month, cost_pool_code, allocation_driver)
        WHERE p.pool_status = 'READY' AND p.costing_treatment = 'Indirect' AND p.source_gl_amount <> 0
          AND COALESCE(t.total_driver_units, 0) = 0""",
        "una": f"""
        SELECT load_run_id, reporting_month, facility, cost_centre_id, natural_account, cost_pool_code, cost_category,
               CASE WHEN starts_with(review_note, 'Cost centre is not mapped') THEN 'UNMAPPED_COST_CENTRE'
                    WHEN starts_with(review_note, 'Natural account is not mapped') THEN 'UNMAPPED_ACCOUNT' ELSE 'REVIEW' END AS unallocated_reason,
               source_gl_amount AS unallocated_amount, 'COST_POOL' AS source_record_type, 'OPEN' AS resolution_status, review_note
        FROM pool WHERE pool_status = 'REVIEW'
        UNION ALL
        SELECT load_run_id, reporting_month, facility, cost_centre_id, natural_account, cost_pool_code, cost_category,
               'EXCLUDED_ADJUSTMENT', source_gl_amount, 'COST_POOL', 'EXCLUDED', review_note
        FROM pool WHERE pool_status = 'EXCLUDED'
        UNION ALL
        SELECT load_run_id, reporting_month, facility, cost_centre_id, natural_account, cost_pool_code, cost_category,
               'ZERO_DRIVER_POOL', source_gl_amount, 'COST_POOL', 'OPEN', {q(K.NOTE_ZERO_DRIVER)}
        FROM zero
        UNION ALL
        SELECT load_run_id, service_month, NULL, cost_centre_id, natural_account, 'DIRECT_COST', 'Direct Cost',
               'FAILED_DIRECT_ASSIGNMENT', amount, 'DIRECT_COST', 'OPEN', {q(K.NOTE_FAILED_DIRECT)}
        FROM dbad""",
        "reach": """
        SELECT load_run_id, reporting_month, cost_pool_code, allocation_driver, SUM(driver_units) AS units
        FROM alloc GROUP BY ALL""",
        "parts": f"""
        SELECT p.*,
               COALESCE((SELECT SUM(amount) FROM dok x WHERE x.service_month = p.reporting_month
                  AND x.cost_centre_id = p.cost_centre_id AND x.natural_account = p.natural_account), 0) AS direct_assigned_amount,
               COALESCE({money("r.rate * CAST(u.units AS DOUBLE)")}, 0) AS indirect_allocated_amount,
               COALESCE({money("o.rate * CAST(o.total_driver_units AS DOUBLE)")}, 0) AS overhead_allocated_amount,
               CASE WHEN p.pool_status = 'REVIEW' OR z.cost_centre_id IS NOT NULL THEN p.source_gl_amount ELSE 0 END AS unallocated_amount,
               CASE WHEN p.pool_status = 'EXCLUDED' THEN p.source_gl_amount ELSE 0 END AS excluded_amount
        FROM pool p
        LEFT JOIN rate r USING (load_run_id, reporting_month, facility, cost_centre_id, natural_account, cost_pool_code)
        LEFT JOIN reach u ON u.reporting_month = p.reporting_month AND u.cost_pool_code = p.cost_pool_code
             AND u.allocation_driver = p.allocation_driver
        LEFT JOIN orate o ON o.reporting_month = p.reporting_month AND o.cost_centre_id = p.cost_centre_id
             AND o.natural_account = p.natural_account AND o.cost_pool_code = p.cost_pool_code
        LEFT JOIN zero z ON z.reporting_month = p.reporting_month AND z.cost_centre_id = p.cost_centre_id
             AND z.natural_account = p.natural_account AND z.cost_pool_code = p.cost_pool_code""",
        "rec_pool": f"""
        SELECT load_run_id, 'COST_POOL' AS reconciliation_level, reporting_month, facility, cost_centre_id, cost_pool_code,
               cost_category, source_gl_amount AS gl_amount, direct_assigned_amount, indirect_allocated_amount,
               overhead_allocated_amount, unallocated_amount, excluded_amount,
               source_gl_amount - direct_assigned_amount - indirect_allocated_amount - overhead_allocated_amount
                 - unallocated_amount - excluded_amount AS reconciliation_difference,
               pool_status, review_note AS pool_note
        FROM parts""",
        "rec": f"""
        SELECT load_run_id, reconciliation_level, reporting_month, facility, cost_centre_id, cost_pool_code, cost_category,
               gl_amount, direct_assigned_amount, indirect_allocated_amount, overhead_allocated_amount, unallocated_amount,
               excluded_amount, reconciliation_difference,
               CASE WHEN ABS(reconciliation_difference) <= 1.00 THEN 'PASS' ELSE 'REVIEW' END AS reconciliation_status,
               CASE WHEN pool_status = 'REVIEW' THEN pool_note
                    WHEN ABS(reconciliation_difference) > 1.00 THEN {q(K.NOTE_POOL_DIFFERENCE)} END AS review_note
        FROM rec_pool
        UNION ALL
        SELECT load_run_id, 'COST_POOL', reporting_month, facility, cost_centre_id, cost_pool_code, cost_category,
               0, 0, 0, 0, SUM(unallocated_amount), 0, -SUM(unallocated_amount), 'REVIEW', {q(K.NOTE_NO_POOL)}
        FROM una WHERE source_record_type <> 'COST_POOL'
        GROUP BY load_run_id, reporting_month, facility, cost_centre_id, cost_pool_code, cost_category""",
        "total": f"""
        SELECT load_run_id, 'TOTAL' AS reconciliation_level, MIN(reporting_month) AS reporting_month,
               CAST(NULL AS VARCHAR) AS facility, CAST(NULL AS VARCHAR) AS cost_centre_id,
               CAST(NULL AS VARCHAR) AS cost_pool_code, CAST(NULL AS VARCHAR) AS cost_category,
               SUM(gl_amount) AS gl_amount, SUM(direct_assigned_amount) AS direct_assigned_amount,
               SUM(indirect_allocated_amount) AS indirect_allocated_amount,
               SUM(overhead_allocated_amount) AS overhead_allocated_amount, SUM(unallocated_amount) AS unallocated_amount,
               SUM(excluded_amount) AS excluded_amount, SUM(reconciliation_difference) AS reconciliation_difference,
               CASE WHEN ABS(SUM(reconciliation_difference)) <= 1.00 THEN 'PASS' ELSE 'REVIEW' END AS reconciliation_status,
               {q(K.NOTE_TOTAL)} AS review_note
        FROM rec GROUP BY load_run_id""",
        "recon": "SELECT * FROM rec UNION ALL SELECT * FROM total",
        # landed text
        "lenc": f"""
        SELECT {", ".join(
            f"{_text(c, s)} AS {c}" for c, s in {
                "encounter_id": None, "patient_id": None, "facility": None, "service_line": None,
                "care_type": f"k % {_BAD} = 1", "admission_date": f"k % {_BAD} = 0", "discharge_date": None,
                "episode_month": None, "activity_group_code": None, "length_of_stay": None,
                "separation_status": None, "age_years": f"k % {_BAD} = 2", "indigenous_status": None,
                "remoteness_area": None, "high_complexity_flag": None, "hospital_acquired_complication_flag": None,
            }.items())}, k FROM enc""",
        "penc": f"SELECT * FROM enc WHERE k % {_BAD} NOT IN (0, 1, 2)",
        "lres": f"""
        SELECT * REPLACE (CASE WHEN k % {_BAD} = 3 THEN -2 ELSE pathology_weighted_units END AS pathology_weighted_units),
               k % {_BAD} = 4 AS bad_bed FROM res""",
        "rres": "SELECT *, bad_bed OR pathology_weighted_units < 0 OR encounter_id NOT IN (SELECT encounter_id FROM penc) AS rejected FROM lres",
        "rdir": f"""
        SELECT *, CAST(encounter_id AS BIGINT) % {_BAD} = 5 AS bad_quantity,
               CAST(encounter_id AS BIGINT) % {_BAD} = 5 OR encounter_id NOT IN (SELECT encounter_id FROM penc) AS rejected FROM dir""",
        "pgl": f"SELECT * FROM gl WHERE k % {_BAD} <> 6",
        "period": """
        SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS reporting_month FROM lineitem""",
    }
)


# Pools kept apart by facility: the ledger stands where its orders are.
CTE.update(
    {
        "gl_apart": "SELECT gl.* REPLACE (enc.facility AS facility) FROM gl JOIN enc ON enc.k = gl.k",
        "mapped_apart": CTE["mapped"].replace("gl", "gl_apart"),
        "pool_apart": CTE["pool"].replace("FROM mapped", "FROM mapped_apart"),
        "drv_apart": "SELECT drv.*, enc.facility FROM drv JOIN enc ON enc.encounter_id = drv.encounter_id",
        "tot_apart": """
        SELECT load_run_id, reporting_month, facility, cost_pool_code, allocation_driver, SUM(driver_units) AS total_driver_units
        FROM drv_apart WHERE driver_units > 0 GROUP BY ALL""",
        "rate_apart": """
        SELECT p.*, t.total_driver_units, CAST(p.source_gl_amount AS DOUBLE) / CAST(t.total_driver_units AS DOUBLE) AS rate
        FROM pool_apart p JOIN tot_apart t USING (load_run_id, reporting_month, facility, cost_pool_code, allocation_driver)
        WHERE p.pool_status = 'READY' AND p.costing_treatment = 'Indirect'""",
        "krate_apart": """
        SELECT load_run_id, reporting_month, facility, cost_pool_code, allocation_driver, SUM(rate) AS rate
        FROM rate_apart GROUP BY ALL""",
        "ind_apart": f"""
        SELECT load_run_id, reporting_month, encounter_id, SUM({money("CAST(driver_units AS DOUBLE) * rate")}) AS allocated_amount
        FROM drv_apart JOIN krate_apart USING (load_run_id, reporting_month, facility, cost_pool_code, allocation_driver)
        WHERE driver_units > 0 GROUP BY ALL""",
        "base_apart": CTE["base"].replace("JOIN ind i", "JOIN ind_apart i"),
        "otot_apart": """
        SELECT load_run_id, reporting_month, facility, SUM(pre) AS total FROM base_apart WHERE pre > 0 GROUP BY ALL""",
        "orate_apart": """
        SELECT p.*, t.total AS total_driver_units, CAST(p.source_gl_amount AS DOUBLE) / CAST(t.total AS DOUBLE) AS rate
        FROM pool_apart p JOIN otot_apart t USING (load_run_id, reporting_month, facility)
        WHERE p.pool_status = 'READY' AND p.costing_treatment = 'Overhead'
          AND p.cost_pool_code = 'OVERHEAD' AND p.allocation_driver = 'pre_overhead_cost'""",
        "cost_apart": CTE["cost"]
        .replace("FROM base ", "FROM base_apart ")
        .replace("reporting_month, SUM(rate) AS rate FROM orate ", "reporting_month, facility, SUM(rate) AS rate FROM orate_apart ")
        .replace("USING (load_run_id, reporting_month)", "USING (load_run_id, reporting_month, facility)"),
        "zero_apart": """
        SELECT p.* FROM pool_apart p
        LEFT JOIN tot_apart t USING (load_run_id, reporting_month, facility, cost_pool_code, allocation_driver)
        WHERE p.pool_status = 'READY' AND p.costing_treatment = 'Indirect' AND p.source_gl_amount <> 0
          AND COALESCE(t.total_driver_units, 0) = 0""",
        "given_apart": f"""
        SELECT facility, 'gl_amount' AS part, SUM(source_gl_amount) AS amount FROM pool_apart GROUP BY ALL
        UNION ALL SELECT e.facility, 'direct_assigned_amount', SUM(amount) FROM dok x
            JOIN enc e ON e.encounter_id = x.encounter_id GROUP BY ALL
        UNION ALL SELECT facility, 'indirect_allocated_amount', SUM({money("rate * CAST(total_driver_units AS DOUBLE)")})
            FROM rate_apart GROUP BY ALL
        UNION ALL SELECT facility, 'overhead_allocated_amount', SUM({money("rate * CAST(total_driver_units AS DOUBLE)")})
            FROM orate_apart GROUP BY ALL
        UNION ALL SELECT facility, 'unallocated_amount', SUM(source_gl_amount) FROM zero_apart GROUP BY ALL
        UNION ALL SELECT facility, 'unallocated_amount', SUM(source_gl_amount) FROM pool_apart
            WHERE pool_status = 'REVIEW' GROUP BY ALL
        UNION ALL SELECT facility, 'excluded_amount', SUM(source_gl_amount) FROM pool_apart
            WHERE pool_status = 'EXCLUDED' GROUP BY ALL""",
    }
)


def _needs(sql: str) -> set[str]:
    words = set(re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", sql))
    return {w for w in words if w in CTE}


def twin(sql: str) -> str:
    """Prefix ``sql`` with the table expressions it reads, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in sorted(_needs(CTE[name])):
            if dep != name and dep not in order:
                visit(dep)
        if name not in order:
            order.append(name)

    for name in sorted(_needs(sql)):
        visit(name)
    parts = ",\n".join(f"{name} AS ({CTE[name].strip()})" for name in order)
    return f"WITH {parts}\n{sql.strip()}" if order else sql.strip()
