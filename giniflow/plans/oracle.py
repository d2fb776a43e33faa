"""Independent SQL (DuckDB dialect) for the registered queries.

Each string starts from the driver's raw tables and rebuilds the scoring sample with the same definition (FIXTURES.md
section 2); hashes are ``('0x'||substr(md5(key||':salt'),1,8))::BIGINT``, which equals the Spark expression bit for bit.
Splits, samples and folds are written the plain SQL way (``row_number() over (order by hash, key)``), so they check the
histogram-based order statistics of the Spark side rather than repeat them.
"""

from __future__ import annotations

from giniflow.functions.hashing import duck_hash, duck_uniform


def _h(salt) -> str:
    return duck_hash("epk_id", salt)


FIXTURE = f"""
_fx_base AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS epk_id,
         l_quantity, l_discount, l_tax, l_extendedprice, o_orderdate, o_orderpriority, c_mktsegment, c_acctbal,
         p_brand, p_size
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey
                JOIN part ON l_partkey = p_partkey
),
scoring_sample AS (
  SELECT epk_id,
         CAST(CAST(year(o_orderdate) AS VARCHAR) || '-12-31' AS DATE) AS report_dt,
         CAST({duck_uniform('epk_id', 19)} < CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-(
              CAST(-2.2 AS DOUBLE) + CAST(0.06 AS DOUBLE) * (l_quantity - 25) - CAST(20.0 AS DOUBLE) * (l_discount - CAST(0.05 AS DOUBLE))
              + CASE c_mktsegment WHEN 'BUILDING' THEN CAST(0.9 AS DOUBLE) WHEN 'MACHINERY' THEN CAST(-0.6 AS DOUBLE)
                                  ELSE CAST(0.0 AS DOUBLE) END))) AS INTEGER) AS trg_flag,
         l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_extendedprice AS price,
         l_quantity + CAST({_h(41)} % 1000 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS quantity_x,
         CASE WHEN {_h(23)} % 40 = 0 THEN NULL ELSE c_acctbal END AS acct_bal,
         CASE WHEN {_h(29)} % 5 = 0 THEN NULL ELSE p_size END AS part_size,
         CASE WHEN {_h(31)} % 100 < 97 THEN NULL ELSE l_tax END AS tax_sparse,
         p_brand AS brand_cd,
         CASE WHEN {_h(37)} % 25 = 0 THEN NULL ELSE c_mktsegment END AS client_segm,
         o_orderpriority AS priority_group
  FROM _fx_base
)"""


def with_fixture(body: str, ctes: str = "") -> str:
    """``WITH <fixture>[, ctes] <body>``."""
    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    return f"WITH {FIXTURE.strip()}{extra}\n{body.strip()}"


def gini_sql(source: str, score: str, label: str, by: list[str] | None = None, digits: int | None = 2,
             scale: float = 100.0, absolute: bool = False) -> str:
    """Gini of ``score`` per group over a CTE/table ``source`` (mid-rank ties), as a SELECT statement."""
    by = by or []
    g = ", ".join(by)
    gsel = f"{g}, " if by else ""
    part = f"PARTITION BY {g} " if by else ""
    raw = (f"(2 * sum(pos * (nb + neg / CAST(2 AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) - 1)"
           f" * CAST({scale} AS DOUBLE)")
    if absolute:
        raw = f"abs({raw})"
    val = f"round({raw}, {digits})" if digits is not None else raw
    return f"""
SELECT {gsel}{val} AS gini
FROM (
  SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM (SELECT {gsel}CAST({score} AS DOUBLE) AS v, CAST(sum({label}) AS DOUBLE) AS pos,
               CAST(sum(1 - {label}) AS DOUBLE) AS neg
        FROM {source} WHERE {score} IS NOT NULL AND {label} IS NOT NULL AND NOT isnan(CAST({score} AS DOUBLE))
        GROUP BY {gsel}CAST({score} AS DOUBLE))
) GROUP BY ALL"""
