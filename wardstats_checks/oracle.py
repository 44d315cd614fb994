"""The same questions in plain SQL, for a second engine to answer.

``ADMISSIONS`` reads the order tables directly, not the text the library
parses. Everything after it refers to ``adm`` alone, so tests can put any other
relation of that name in front.
"""

ADMISSIONS = """
adm AS (
  SELECT p_type AS condition, l_returnflag AS admission_type, c_mktsegment AS provider,
         CAST(l_quantity AS INTEGER) AS los,
         CAST(l_extendedprice AS DECIMAL(18, 2)) AS bill,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS admit,
         CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS VARCHAR) AS discharge
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
)"""

# Relations built from adm, each listing what it needs.
RELATIONS = {
    "everyone": ((), """
      SELECT COUNT(*) AS n, CAST(SUM(los) AS DOUBLE) AS days,
             CAST(SUM(los) AS DOUBLE) / COUNT(los) AS mean_los
      FROM adm"""),
    "combo": ((), """
      SELECT condition, admission_type, COUNT(*) AS n,
             CAST(SUM(los) AS DOUBLE) AS days,
             CAST(SUM(los) AS DOUBLE) / COUNT(los) AS mean_los,
             CAST(SUM(bill) AS DOUBLE) AS charges,
             CAST(SUM(bill) AS DOUBLE) / COUNT(bill) AS mean_bill
      FROM adm GROUP BY condition, admission_type"""),
    "payer": ((), """
      SELECT provider, COUNT(*) AS n,
             CAST(SUM(los) AS DOUBLE) AS days,
             CAST(SUM(los) AS DOUBLE) / COUNT(los) AS mean_los,
             CAST(SUM(bill) AS DOUBLE) AS charges,
             CAST(SUM(bill) AS DOUBLE) / COUNT(bill) AS mean_bill
      FROM adm GROUP BY provider"""),
    "norm": ((), """
      SELECT condition, COUNT(*) AS n, CAST(SUM(bill) AS DOUBLE) / COUNT(bill) AS benchmark
      FROM adm GROUP BY condition"""),
    "gap": (("combo", "norm"), """
      SELECT combo.*, benchmark, mean_bill - benchmark AS usd,
             (mean_bill - benchmark) / NULLIF(benchmark, 0) * 100 AS pct
      FROM combo JOIN norm ON combo.condition = norm.condition"""),
    "graded": (("gap",), """
      SELECT *, CASE WHEN pct > 2 THEN 'Above Benchmark'
                     WHEN pct < 0 THEN 'Below Benchmark'
                     ELSE 'Near Benchmark' END AS classification
      FROM gap"""),
    "share": (("combo", "everyone"), """
      SELECT combo.*,
             combo.n * CAST(100 AS DOUBLE) / everyone.n AS n_share,
             combo.days * CAST(100 AS DOUBLE) / NULLIF(everyone.days, 0) AS day_share,
             combo.days * CAST(100 AS DOUBLE) / NULLIF(everyone.days, 0)
               - combo.n * CAST(100 AS DOUBLE) / everyone.n AS difference
      FROM combo, everyone"""),
    "priority": (("share", "gap"), """
      SELECT share.*, gap.benchmark, gap.pct
      FROM share JOIN gap ON share.condition = gap.condition
                         AND share.admission_type = gap.admission_type
      WHERE difference > 0 AND pct > 0"""),
}


def _r(expr: str, places: int, name: str) -> str:
    return f"ROUND({expr}, {places}) + 0.0 AS {name}"


KEYS = "condition, admission_type"
COUNT = "n AS admission_count"
LOS1, LOS2 = _r("mean_los", 1, "average_los"), _r("mean_los", 2, "average_los")
DAYS = _r("days", 0, "total_patient_days")
BILL = f"{_r('mean_bill', 2, 'average_billing')}, {_r('charges', 2, 'total_billing')}"
NORM = f"{_r('mean_bill', 2, 'average_billing')}, {_r('benchmark', 2, 'condition_benchmark')}"
USD, PCT = _r("usd", 2, "variance_usd"), _r("pct", 2, "variance_pct")
ABS_PCT = _r("ABS(pct)", 2, "abs_variance_pct")
SHARES = ", ".join((
    _r("n_share", 2, "admission_share"),
    _r("day_share", 2, "patient_day_share"),
    _r("difference", 2, "share_difference"),
))


def _profile(column: str, value: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", 'string' AS \"type\", COUNT(*) AS n_rows, "
        f"COUNT(*) - COUNT({value}) AS n_null, CAST(0 AS BIGINT) AS n_invalid FROM adm"
    )


# Query name -> (relations it needs, final select).
QUESTIONS = {
    "q01_column_profile": ((), " UNION ALL ".join((
        _profile("Medical Condition", "condition"),
        _profile("Admission Type", "admission_type"),
        _profile("Insurance Provider", "provider"),
        _profile("Billing Amount", "bill"),
        _profile("Date of Admission", "admit"),
        _profile("Discharge Date", "discharge"),
    ))),
    "q02_los_sample": ((), """
        SELECT admit, discharge, CAST(los AS DOUBLE) AS los FROM adm ORDER BY 1, 2, 3 LIMIT 10"""),
    "q03_overall_average_los": (("everyone",), f"SELECT {LOS1} FROM everyone"),
    "q04_admissions_by_condition": (("norm", "everyone"), f"""
        SELECT condition, norm.n AS admission_count,
               {_r("norm.n * CAST(100 AS DOUBLE) / everyone.n", 2, "pct_of_admissions")}
        FROM norm, everyone"""),
    "q05_admission_types_within_condition": (("combo", "norm"), f"""
        SELECT combo.condition, admission_type, combo.n AS admission_count,
               {_r("combo.n * CAST(100 AS DOUBLE) / norm.n", 2, "pct_of_condition")}
        FROM combo LEFT JOIN norm ON combo.condition = norm.condition"""),
    "q06_average_los_by_combo": (("combo",), f"SELECT {KEYS}, {COUNT}, {LOS1} FROM combo"),
    "q07_combos_above_average_los": (("combo", "everyone"), f"""
        SELECT {KEYS}, {COUNT}, {LOS1} FROM combo
        WHERE mean_los > (SELECT mean_los FROM everyone)"""),
    "q08_high_volume_high_los_combos": (("combo", "everyone"), f"""
        SELECT {KEYS}, {COUNT}, {LOS1} FROM combo
        WHERE mean_los > (SELECT mean_los FROM everyone)
          AND n > (SELECT CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT condition || '|' || admission_type)
                   FROM adm)"""),
    "q09_estimated_patient_days": (("combo",), f"""
        SELECT {KEYS}, {COUNT}, {LOS1}, {_r("n * mean_los", 0, "est_patient_days")} FROM combo"""),
    "q10_total_patient_days": (("combo",), f"SELECT {KEYS}, {COUNT}, {LOS1}, {DAYS} FROM combo"),
    "q11_utilization_by_provider": (("payer",), f"SELECT provider, {COUNT}, {LOS1}, {DAYS} FROM payer"),
    "q12_billing_by_provider": (("payer",), f"SELECT provider, {COUNT}, {BILL} FROM payer"),
    "q13_billing_by_combo": (("combo",), f"SELECT {KEYS}, {COUNT}, {BILL} FROM combo"),
    "q14_combos_above_benchmark": (("gap",), f"""
        SELECT {KEYS}, {COUNT}, {NORM} FROM gap WHERE mean_bill > benchmark"""),
    "q15_variance_usd": (("gap",), f"SELECT {KEYS}, {NORM}, {USD} FROM gap"),
    "q16_variance_pct": (("gap",), f"SELECT {KEYS}, {NORM}, {USD}, {PCT} FROM gap"),
    "q17_variance_classification": (("graded",), f"""
        SELECT {KEYS}, {NORM}, {USD}, {PCT}, classification FROM graded"""),
    "q18_absolute_variance": (("graded",), f"""
        SELECT {KEYS}, {NORM}, {USD}, {PCT}, {ABS_PCT}, classification FROM graded"""),
    "q19_largest_variance_per_condition": (("gap",), f"""
        SELECT {KEYS}, {NORM}, {USD}, {PCT}, {ABS_PCT} FROM gap
        WHERE NOT EXISTS (SELECT 1 FROM gap AS other
                          WHERE other.condition = gap.condition AND ABS(other.pct) > ABS(gap.pct))
          AND pct IS NOT NULL"""),
    "q20_combos_per_class": (("graded",), """
        SELECT classification, COUNT(*) AS n_combos FROM graded GROUP BY classification"""),
    "q21_class_shares": (("graded",), f"""
        SELECT classification, COUNT(*) AS n_combos,
               {_r("COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM graded)", 2, "pct_of_combos")}
        FROM graded GROUP BY classification"""),
    "q22_long_stay_above_benchmark": (("combo", "gap", "everyone"), f"""
        SELECT gap.condition, gap.admission_type, gap.n AS admission_count,
               {_r("gap.mean_los", 2, "average_los")}, {PCT}
        FROM gap JOIN combo ON gap.condition = combo.condition
                           AND gap.admission_type = combo.admission_type
        WHERE pct > 0 AND gap.mean_los > (SELECT mean_los FROM everyone)"""),
    "q23_patient_days_above_benchmark": (("combo", "gap"), f"""
        SELECT gap.condition, gap.admission_type, gap.n AS admission_count,
               {_r("gap.days", 0, "total_patient_days")}, {PCT}
        FROM gap JOIN combo ON gap.condition = combo.condition
                           AND gap.admission_type = combo.admission_type
        WHERE pct > 0"""),
    "q24_patient_day_share": (("share",), f"""
        SELECT {KEYS}, {COUNT}, {DAYS}, {_r("day_share", 2, "pct_of_days")} FROM share"""),
    "q25_over_share_combos": (("share",), f"""
        SELECT {KEYS}, {COUNT}, {DAYS}, {SHARES} FROM share WHERE difference > 0"""),
    "q26_longest_stay_over_share": (("share",), f"""
        SELECT {KEYS}, {COUNT}, {LOS2}, {SHARES} FROM share WHERE difference > 0
        ORDER BY mean_los DESC, condition NULLS FIRST, admission_type NULLS FIRST LIMIT 1"""),
    "q27_priority_combos": (("priority",), f"""
        SELECT {KEYS}, {LOS2}, {_r("difference", 2, "share_difference")}, {NORM}, {PCT}
        FROM priority"""),
    "q28_priority_condition": (("priority",), f"""
        SELECT condition, {_r("SUM(days)", 0, "combined_total_patient_days")}
        FROM priority GROUP BY condition ORDER BY SUM(days) DESC, condition LIMIT 1"""),
    "admission_facts": ((), """
        SELECT condition, admission_type, provider, CAST(los AS DOUBLE) AS los_days,
               CAST(bill AS DOUBLE) AS billing FROM adm"""),
    "admission_summary": ((), f"""
        SELECT {KEYS}, provider, COUNT(*) AS n, COUNT(los) AS los_n,
               CAST(SUM(los) AS DOUBLE) AS patient_days, COUNT(bill) AS bill_n,
               CAST(SUM(bill) AS DOUBLE) AS total_billing
        FROM adm GROUP BY condition, admission_type, provider"""),
    "utilization": (("combo",), f"""
        SELECT {KEYS}, {COUNT}, mean_los AS average_los, days AS total_patient_days FROM combo"""),
    "benchmark_variance": (("gap",), f"""
        SELECT {KEYS}, mean_bill AS average_billing, benchmark AS condition_benchmark,
               usd AS variance_usd, pct AS variance_pct FROM gap"""),
    "variance_class": (("graded",), f"SELECT {KEYS}, classification FROM graded"),
    "share_of_total": (("share",), f"""
        SELECT {KEYS}, n_share AS admission_share, day_share AS patient_day_share FROM share"""),
    "share_difference": (("share",), f"""
        SELECT {KEYS}, difference AS share_difference, difference > 0 AS over_share FROM share"""),
    "priority_combos": (("priority",), f"""
        SELECT {KEYS}, days AS total_patient_days, difference AS share_difference,
               pct AS variance_pct FROM priority"""),
}


def statement(name: str, admissions: str = ADMISSIONS) -> str:
    """One SQL statement for a question, over the given ``adm`` relation."""
    needed, select = QUESTIONS[name]
    order: list[str] = []

    def visit(relation: str) -> None:
        for dependency in RELATIONS[relation][0]:
            visit(dependency)
        if relation not in order:
            order.append(relation)

    for relation in needed:
        visit(relation)
    ctes = [admissions] + [f"{r} AS ({RELATIONS[r][1]})" for r in order]
    return f"WITH {', '.join(ctes)} {select.strip()}"
