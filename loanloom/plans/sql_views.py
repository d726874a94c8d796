"""The views as SQL text in the catalog, expanded when they are read.

A view holds a query, not a result: peer counts, totals and ranks are those of the rows that the base tables hold
when somebody selects from it. The peers' windows run over counts per distinct value, in two levels for amounts, so
that a grade with a third of all loans is never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from loanloom.operators.features import BASE_COLUMNS, MODEL_COLUMNS, PEER_COLUMNS
from loanloom.operators.vintage import CRISIS_YEARS
from loanloom.plans.views import VIEW_NAMES

#: Where the views look for the base rows; a name of its own keeps it out of the seven.
PEER_BASE = "loans_with_peers"

_BASE = f"""
SELECT {{base}} FROM (
  SELECT l.*, c.annual_income, c.employment_length, c.region, c.dti, c.home_ownership,
    r.amount_paid AS last_payment_amount, r.days_late AS had_delinquency,
    round(CAST(l.loan_amount AS DOUBLE) / nullif(CAST(c.annual_income AS DOUBLE), 0), 4) AS loan_to_income_ratio
  FROM loans l JOIN customers c ON l.customer_id = c.customer_id LEFT JOIN repayments r ON r.loan_id = l.loan_id
)"""

# Rows of counts: (grade, rate), (grade, amount) and (region), told apart by which columns are grouped.
_PEERS = """
WITH counts AS (
  SELECT grade, interest_rate, loan_amount, region, count(*) AS n, count(default_flag) AS known,
    coalesce(sum(default_flag), 0) AS defaults, grouping(interest_rate) AS not_rate, grouping(loan_amount) AS not_amount
  FROM loan_base_features GROUP BY GROUPING SETS ((grade, interest_rate), (grade, loan_amount), (region))
),
rates AS (
  SELECT grade, interest_rate, sum(n) OVER (PARTITION BY grade ORDER BY interest_rate NULLS FIRST) - n AS n_below,
    sum(n) OVER (PARTITION BY grade) AS n_total, sum(known) OVER (PARTITION BY grade) AS known,
    sum(defaults) OVER (PARTITION BY grade) AS defaults
  FROM counts WHERE not_rate = 0
),
buckets AS (
  SELECT grade, floor(loan_amount / 10000) AS bucket, sum(n) AS n FROM counts WHERE not_amount = 0 GROUP BY 1, 2
),
higher AS (
  SELECT grade, bucket, sum(n) OVER (PARTITION BY grade ORDER BY bucket DESC NULLS LAST) - n AS n_higher FROM buckets
),
amounts AS (
  SELECT c.grade, c.loan_amount,
    h.n_higher + sum(c.n) OVER (PARTITION BY c.grade, h.bucket ORDER BY c.loan_amount DESC NULLS LAST) - c.n AS n_above
  FROM counts c JOIN higher h ON c.grade <=> h.grade AND floor(c.loan_amount / 10000) <=> h.bucket
  WHERE c.not_amount = 0
),
regions AS (
  SELECT region, defaults / nullif(known, 0) AS region_default_rate FROM counts WHERE not_rate = 1 AND not_amount = 1
)
SELECT b.*,
  CASE WHEN r.n_total = 1 THEN 0.0D ELSE r.n_below / (r.n_total - 1) END AS interest_rate_percentile_in_grade,
  r.defaults / nullif(r.known, 0) AS grade_default_rate,
  g.region_default_rate,
  a.n_above + 1 AS loan_amount_rank_in_grade
FROM loan_base_features b
JOIN rates r ON b.grade <=> r.grade AND b.interest_rate <=> r.interest_rate
JOIN amounts a ON b.grade <=> a.grade AND b.loan_amount <=> a.loan_amount
JOIN regions g ON b.region <=> g.region"""

_MONTHLY = """
SELECT *, avg(monthly_default_rate) OVER (ORDER BY issue_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    AS rolling_3m_default_rate
FROM (
  SELECT date_format(issue_date, 'yyyy-MM-01') AS issue_month, count(*) AS loans_issued,
    sum(default_flag) AS loans_defaulted, avg(default_flag) AS monthly_default_rate
  FROM loans WHERE issue_date IS NOT NULL GROUP BY 1
) ORDER BY issue_month"""

_VINTAGE_BASE = """
SELECT * FROM (
  SELECT l.loan_id, concat(year(issue_date), '-Q', quarter(issue_date)) AS origination_quarter, default_flag,
    CAST(timestampdiff(MONTH, issue_date, payment_date) AS INT) AS months_on_book
  FROM loans l JOIN repayments r ON l.loan_id = r.loan_id WHERE issue_date IS NOT NULL AND payment_date IS NOT NULL
) WHERE months_on_book BETWEEN 0 AND 60"""

# Loans are counted per quarter and bucket before the grid is laid; they are never multiplied by it.
_VINTAGE = """
WITH counted AS (
  SELECT origination_quarter, CAST(ceil(months_on_book / 3) * 3 AS INT) AS mob_bucket, count(*) AS loans,
    count_if(default_flag = 1) AS defaults
  FROM vintage_loan_base GROUP BY 1, 2
),
cohorts AS (
  SELECT origination_quarter, sum(loans) AS cohort_size, map_from_entries(collect_list(struct(mob_bucket, defaults))) AS by_bucket
  FROM counted GROUP BY 1
),
grid AS (SELECT *, explode(sequence(0, 60, 3)) AS mob_bucket FROM cohorts),
curve AS (
  SELECT origination_quarter, cohort_size, mob_bucket,
    sum(coalesce(try_element_at(by_bucket, mob_bucket), 0)) OVER (PARTITION BY origination_quarter ORDER BY mob_bucket)
      AS cumulative_defaults
  FROM grid
)
SELECT *, round(cumulative_defaults / cohort_size, 4) AS cumulative_default_rate,
  CASE WHEN left(origination_quarter, 4) IN ({crisis}) THEN 1 ELSE 0 END AS is_crisis_vintage
FROM curve ORDER BY origination_quarter, mob_bucket"""

_YEARLY = """
SELECT year(issue_date) AS origination_year, count(*) AS n_loans, round(avg(default_flag), 4) AS default_rate
FROM loans WHERE issue_date IS NOT NULL GROUP BY 1 ORDER BY 1"""


def view_texts(crisis_years: Sequence[int] = CRISIS_YEARS) -> dict[str, str]:
    """The text of every view, in the order in which they build on each other."""
    peers = ["loan_id", "grade", "region", "issue_date", "interest_rate", "default_flag", *PEER_COLUMNS]
    return {
        "loan_base_features": _BASE.format(base=", ".join(BASE_COLUMNS)),
        PEER_BASE: _PEERS,
        "loan_peer_benchmark_features": f"SELECT {', '.join(peers)} FROM {PEER_BASE}",
        "monthly_default_trend": _MONTHLY,
        "final_model_features": f"SELECT {', '.join(MODEL_COLUMNS)} FROM {PEER_BASE}",
        "vintage_loan_base": _VINTAGE_BASE,
        "vintage_analysis": _VINTAGE.format(crisis=", ".join(f"'{int(y)}'" for y in crisis_years) or "NULL"),
        "yearly_origination_quality": _YEARLY,
    }


def create_views(spark: SparkSession, tables: Mapping[str, str], crisis_years: Sequence[int] = CRISIS_YEARS) -> list[str]:
    """Create or replace ``loans``, ``customers``, ``repayments`` and the seven views as SQL text; returns their names.

    ``tables`` says what stands for each base table: a catalog table's name or the path of a Parquet table. Texts
    are parsed and files are listed at every read, so rows that are appended later show up in all views.
    """
    for name in ("loans", "customers", "repayments"):
        place = tables[name]
        relation = f"parquet.`{place}`" if "/" in place else place
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {relation}")
    for name, text in view_texts(crisis_years).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text}")
    return ["loans", "customers", "repayments", *VIEW_NAMES]
