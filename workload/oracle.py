"""The same results as plain SQL over the given tables.

Each report is written the long way round, one filtered group sum per column
joined on the key, so that it checks the fused Spark plans independently.
"""

from __future__ import annotations

from workload.periods import DETAIL_FROM, by_month, periods, reported

OUT = "OVERDUE_STATUS_3 <> 2"
OD = "OVERDUE_STATUS_3 = 1"
BO = "MATURITY_DAYS > 0"
BN = "MATURITY_DAYS >= 3"
LATEST = "DATA_DT = (SELECT max(DATA_DT) FROM facts)"

POPULATIONS = {
    "all": "TRUE",
    "excl": "PROV_CD NOT LIKE '35%'",
    "excl_code": "PROV_CD <> '3502'",
}

LEDGER = """
ranked AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS BD,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS K
  FROM orders),
ledger_base AS (
  SELECT l_orderkey AS LOAN_ID, o_custkey AS CUST, c_nationkey AS NATION, n_regionkey AS REGION,
         BD, CAST(K AS INTEGER) AS K, l_linenumber AS LN,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS AMT,
         BD + CAST(30 * l_linenumber AS INTEGER) AS DUE,
         (o_orderkey * 7 + o_custkey * 3) % 20 AS B, o_orderkey % 3 AS B3
  FROM lineitem JOIN ranked ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
ledger AS (
  SELECT LOAN_ID, CUST, NATION, REGION, BD, K, AMT, DUE,
         CASE WHEN B < 12 THEN DUE
              WHEN B < 16 THEN DUE + CAST(15 * (B - 11) + 2 * LN AS INTEGER)
              WHEN B < 18 THEN DUE + CAST(130 + LN AS INTEGER)
              WHEN LN <= B3 THEN DUE END AS PAID
  FROM ledger_base)"""

STATE = """
state AS (
  SELECT DATA_DT, P, LOAN_ID, CUST, NATION, REGION, BD, K,
         CAST(sum(AMT) AS BIGINT) AS LOAN_PR,
         CAST(coalesce(sum(AMT) FILTER (UNPAID), 0) AS BIGINT) AS BAL,
         CAST(coalesce(sum(AMT) FILTER (UNPAID AND DUE < DATA_DT), 0) AS BIGINT) AS OD_PRINCIPAL,
         coalesce(max(DATA_DT - DUE) FILTER (UNPAID AND DUE < DATA_DT), 0) AS OD_DAYS,
         max(DUE) AS MATURITY,
         CAST(coalesce(sum(AMT) FILTER (DUE > P AND DUE <= DATA_DT), 0) AS BIGINT) AS DIFF_SP_AMT,
         CAST(coalesce(sum(AMT) FILTER (PAID > P AND PAID <= DATA_DT), 0) AS BIGINT) AS DIFF_AP_AMT
  FROM (SELECT *, (PAID IS NULL OR PAID > DATA_DT) AS UNPAID FROM ledger JOIN periods ON BD <= DATA_DT)
  GROUP BY ALL),
coded AS (
  SELECT *, OD_PRINCIPAL + OD_PRINCIPAL * 5 // 100 AS OD_AMT,
         CAST(31 + REGION AS VARCHAR) || lpad(CAST(NATION // 5 + 1 AS VARCHAR), 2, '0') AS PROV_CD,
         CASE WHEN BAL = 0 THEN 2 WHEN OD_DAYS > 0 THEN 1 ELSE 0 END AS OVERDUE_STATUS_3,
         CASE WHEN BAL = 0 OR OD_DAYS = 0 THEN 0 WHEN OD_DAYS <= 3 THEN 1 WHEN OD_DAYS <= 30 THEN 2
              WHEN OD_DAYS <= 60 THEN 3 ELSE 4 END AS OVERDUE_STATUS_5,
         CASE WHEN OD_DAYS > 60 THEN 1 ELSE 0 END AS STATUS_THIS_MONTH
  FROM state),
facts_all AS (
  SELECT LOAN_ID, DATA_DT, {begin} AS BEGIN_DATE, PROV_CD,
         PROV_CD || lpad(CAST(CUST % 3 + 1 AS VARCHAR), 2, '0') AS SHENGSHI_CD,
         OVERDUE_STATUS_3, lag(OVERDUE_STATUS_3) OVER h AS OVERDUE_STATUS_3_LAST,
         OVERDUE_STATUS_5, lag(OVERDUE_STATUS_5) OVER h AS OVERDUE_STATUS_5_LAST,
         CASE WHEN BAL = 0 THEN 2 WHEN OD_DAYS >= 30 THEN 1 ELSE 0 END AS OVERDUE_STATUS_3_30,
         STATUS_THIS_MONTH, lag(STATUS_THIS_MONTH) OVER h AS STATUS_LAST_MONTH,
         CAST(CASE WHEN MATURITY > DATA_DT THEN -1 ELSE DATA_DT - MATURITY END AS INTEGER) AS MATURITY_DAYS,
         CASE WHEN BD > P THEN 1 ELSE 0 END AS NEW_LOAN,
         K AS RELOAN, K AS RELOANTIMES, K AS BRELOAN,
         CASE WHEN CUST % 5 = 0 THEN 1 ELSE 0 END AS LIGHT,
         CASE WHEN LOAN_PR < 5000000 THEN 1 WHEN LOAN_PR < 15000000 THEN 2
              WHEN LOAN_PR < 30000000 THEN 3 ELSE 4 END AS LOAN_PR_SCOPE,
         CAST(12 * (year(DATA_DT) - year(BD)) + month(DATA_DT) - month(BD) AS INTEGER) AS LOAN_M_CNT,
         CAST(1 AS BIGINT) AS CNT, BAL, LOAN_PR, LOAN_PR + LOAN_PR * 6 // 100 AS LOAN_PR_FEE,
         CASE WHEN BD > P THEN LOAN_PR ELSE 0 END AS NEW_AMT, OD_AMT, OD_PRINCIPAL,
         CASE WHEN OD_DAYS >= 30 THEN OD_AMT ELSE 0 END AS OD_AMT_30,
         CASE WHEN OD_DAYS >= 30 THEN OD_PRINCIPAL ELSE 0 END AS OD_PRINCIPAL_30,
         OD_AMT - coalesce(lag(OD_AMT) OVER h, 0) AS DIFF_OD_AMT, DIFF_SP_AMT, DIFF_AP_AMT
  FROM coded WINDOW h AS (PARTITION BY LOAN_ID ORDER BY DATA_DT)),
facts AS MATERIALIZED (SELECT * FROM facts_all WHERE {where})"""

DIMS = """
places AS (SELECT CAST(31 + n_regionkey AS VARCHAR) || lpad(CAST(n_nationkey // 5 + 1 AS VARCHAR), 2, '0')
                  AS CODE, n_name FROM nation),
dims AS (SELECT 'PROV_CD' AS COL, CODE, n_name AS NAME FROM places WHERE CODE <> '3103'
         UNION ALL
         SELECT 'SHENGSHI_CD', CODE || S, n_name || '-' || S FROM places, (VALUES ('01'), ('02'), ('03')) v(S))"""


def facts_sql(cadence: str, population: str = "all") -> str:
    rows = ", ".join(f"(DATE '{p.day}', DATE '{p.before}')" for p in periods(cadence))
    days = ", ".join(f"DATE '{d}'" for d in reported(cadence))
    state = STATE.format(
        begin="last_day(BD)" if by_month(cadence) else "BD",
        where=f"{POPULATIONS[population]} AND DATA_DT IN ({days})",
    )
    return f"WITH periods(DATA_DT, P) AS (VALUES {rows}),{LEDGER},{state},{DIMS}"


class Reports:
    """SQL of every report for one cadence and population."""

    def __init__(self, cadence: str, population: str = "all"):
        self.cadence = cadence
        self.monthly = by_month(cadence)
        self.head = facts_sql(cadence, population)

    # -- pieces ------------------------------------------------------------

    def sql(self, select: str, *ctes: str) -> str:
        return self.head + "".join(f",\n{c}" for c in ctes) + "\n" + select

    def key(self, day: str = "DATA_DT") -> str:
        return f"strftime({day}, '{'%Y-%m' if self.monthly else '%Y-%m-%d'}')"

    def span(self) -> str:
        if not self.monthly:
            return self.key()
        return (
            "CAST(month(DATA_DT - INTERVAL 1 MONTH) AS VARCHAR) || '-' || "
            "CAST(month(DATA_DT) AS VARCHAR) || '月汇总'"
        )

    @staticmethod
    def part(key: str, sums: dict[str, str], where: str = "TRUE", source: str = "facts") -> str:
        columns = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {n}" for n, m in sums.items())
        return f"(SELECT {key}, {columns} FROM {source} WHERE {where} GROUP BY {key})"

    @classmethod
    def outer(cls, key: str, *parts: str) -> str:
        joined = parts[0] + " q0"
        for i, part in enumerate(parts[1:], 1):
            joined += f"\n  FULL OUTER JOIN {part} q{i} USING ({key})"
        return f"SELECT * FROM {joined}"

    @staticmethod
    def fill(*names: str) -> str:
        return ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)

    @staticmethod
    def rate(a: str, b: str) -> str:
        return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"

    @staticmethod
    def with_total(source: str, key: str, names: list[str]) -> str:
        total = ", ".join(f"CAST(sum({n}) AS BIGINT)" for n in names)
        return f"SELECT {key}, {', '.join(names)} FROM {source} UNION ALL SELECT NULL, {total} FROM {source}"

    @staticmethod
    def named(source: str, key: str) -> str:
        return f"{source} LEFT JOIN (SELECT CODE, NAME FROM dims WHERE COL = '{key}') d ON {source}.{key} = d.CODE"

    # -- overdue -----------------------------------------------------------

    def overdue_by_date(self) -> str:
        k = "DATA_DT"
        m = self.outer(
            k,
            self.part(k, {"out_cnt": "CNT"}, OUT),
            self.part(k, {"cnt": "CNT", "loan_pr": "LOAN_PR", "od_amt": "OD_AMT", "bal": "BAL"}),
            self.part(k, {"od_cnt": "CNT"}, OD),
            self.part(k, {"bo_cnt": "CNT", "bo_amt": "OD_AMT"}, f"{OD} AND {BO}"),
            self.part(k, {"bn_cnt": "CNT", "bn_amt": "OD_AMT"}, f"{OD} AND {BN}"),
        )
        names = ["out_cnt", "cnt", "loan_pr", "od_cnt", "bo_cnt", "bn_cnt", "od_amt", "bo_amt", "bn_amt", "bal"]
        return self.sql(
            f"SELECT {self.key()} AS data_dt, {', '.join(names)}, {self.rate('od_amt', 'bal')} AS od_rate, "
            f"{self.rate('bo_amt', 'bal')} AS bo_rate, {self.rate('bn_amt', 'bal')} AS bn_rate FROM f",
            f"m AS ({m})",
            f"f AS (SELECT DATA_DT, {self.fill(*names)} FROM m)",
        )

    def overdue_by_province(self) -> str:
        k = "PROV_CD"
        m = self.outer(
            k,
            self.part(k, {"out_cnt": "CNT"}, f"{OUT} AND {LATEST}"),
            self.part(k, {"bal": "BAL"}, LATEST),
            self.part(k, {"od_cnt": "CNT", "od_amt": "OD_AMT"}, f"{OD} AND {LATEST}"),
            self.part(k, {"bo_cnt": "CNT", "bo_amt": "OD_AMT"}, f"{OD} AND {BO} AND {LATEST}"),
            self.part(k, {"bn_cnt": "CNT", "bn_amt": "OD_AMT"}, f"{OD} AND {BN} AND {LATEST}"),
            self.part(k, {"od_bal": "BAL"}, f"{OD} AND {LATEST}"),
        )
        names = ["out_cnt", "bal", "od_cnt", "od_amt", "bo_cnt", "bo_amt", "bn_cnt", "bn_amt", "od_bal"]
        return self.sql(
            f"SELECT PROV_CD AS code, NAME AS name, {', '.join(names)}, {self.rate('od_amt', 'bal')} AS od_rate, "
            f"{self.rate('bo_amt', 'bal')} AS bo_rate, {self.rate('bn_amt', 'bal')} AS bn_rate, "
            f"{self.rate('od_bal', 'bal')} AS od_bal_rate FROM {self.named('t', k)}",
            f"m AS ({m})",
            f"f AS (SELECT PROV_CD, {self.fill(*names)} FROM m)",
            f"t AS ({self.with_total('f', k, names)})",
        )

    def overdue_by_city(self) -> str:
        k = "SHENGSHI_CD"
        m = self.outer(
            k,
            self.part(k, {"out_cnt": "CNT"}, f"{OUT} AND {LATEST}"),
            self.part(k, {"bal": "BAL"}, LATEST),
            self.part(k, {"od_cnt": "CNT", "od_amt": "OD_AMT"}, f"{OD} AND {LATEST}"),
        )
        names = ["out_cnt", "bal", "od_cnt", "od_amt"]
        return self.sql(
            f"SELECT SHENGSHI_CD AS code, NAME AS name, {', '.join(names)}, "
            f"{self.rate('od_amt', 'bal')} AS od_rate FROM {self.named('t', k)}",
            f"m AS ({m})",
            f"f AS (SELECT SHENGSHI_CD, {self.fill(*names)} FROM m)",
            f"t AS ({self.with_total('f', k, names)})",
        )

    def overdue_by_scope(self) -> str:
        k = "LOAN_PR_SCOPE"
        m = self.outer(
            k,
            self.part(k, {"cnt": "CNT", "loan_pr": "LOAN_PR", "bal": "BAL"}, f"{OUT} AND {LATEST}"),
            self.part(k, {"od_cnt": "CNT", "od_amt": "OD_AMT"}, f"{OD} AND {LATEST}"),
        )
        names = ["cnt", "loan_pr", "bal", "od_cnt", "od_amt"]
        return self.sql(
            f"SELECT LOAN_PR_SCOPE AS loan_pr_scope, {', '.join(names)}, {self.rate('od_amt', 'bal')} AS od_rate FROM t",
            f"m AS ({m})",
            f"t AS ({self.with_total('m', k, names)})",
        )

    # -- reloan ------------------------------------------------------------

    def _ordinal(self, k: str, prefix: str, which: str, also: str = "TRUE") -> str:
        which = f"{which} AND {also}"
        return self.outer(
            k,
            self.part(k, {f"{prefix}_cnt": "CNT"}, f"{which} AND {OUT}"),
            self.part(k, {f"{prefix}_od_cnt": "CNT"}, f"{which} AND {OD}"),
            self.part(k, {f"{prefix}_bal": "BAL"}, which),
            self.part(k, {f"{prefix}_od_amt": "OD_AMT"}, which),
        )

    def reloan_overdue_by_date(self) -> str:
        k = "DATA_DT"
        every = self.outer(
            k,
            self.part(k, {"all_cnt": "CNT"}, OUT),
            self.part(k, {"all_od_cnt": "CNT"}, OD),
            self.part(k, {"all_od_amt": "OD_AMT"}),
            self.part(k, {"all_bo_amt": "OD_AMT"}, BO),
            self.part(k, {"all_bn_amt": "OD_AMT"}, BN),
            self.part(k, {"all_bal": "BAL"}),
        )
        ordinal = ("cnt", "od_cnt", "bal", "od_amt")
        names = [f"{p}_{c}" for p in ("first", "repeat") for c in ordinal]
        names += ["all_cnt", "all_od_cnt", "all_od_amt", "all_bo_amt", "all_bn_amt", "all_bal"]
        return self.sql(
            f"SELECT {self.key()} AS data_dt, {', '.join(names)}, "
            f"{self.rate('first_od_amt', 'first_bal')} AS first_od_rate, "
            f"{self.rate('repeat_od_amt', 'repeat_bal')} AS repeat_od_rate, "
            f"{self.rate('all_od_amt', 'all_bal')} AS all_od_rate, "
            f"{self.rate('all_bo_amt', 'all_bal')} AS all_bo_rate, "
            f"{self.rate('all_bn_amt', 'all_bal')} AS all_bn_rate "
            f"FROM a FULL OUTER JOIN b USING (DATA_DT) FULL OUTER JOIN c USING (DATA_DT)",
            f"a AS ({self._ordinal(k, 'first', 'RELOAN = 1')})",
            f"b AS ({self._ordinal(k, 'repeat', 'RELOAN <> 1')})",
            f"c AS ({every})",
        )

    def reloan_overdue_by_province(self) -> str:
        k = "PROV_CD"
        every = self.outer(
            k,
            self.part(k, {"all_cnt": "CNT"}, f"{OUT} AND {LATEST}"),
            self.part(k, {"all_od_cnt": "CNT"}, f"{OD} AND {LATEST}"),
            self.part(k, {"all_bal": "BAL"}, LATEST),
            self.part(k, {"all_od_amt": "OD_AMT"}, LATEST),
            self.part(k, {"all_bo_cnt": "CNT"}, f"{BO} AND {OUT} AND {LATEST}"),
            self.part(k, {"all_bo_amt": "OD_AMT"}, f"{BO} AND {LATEST}"),
            self.part(k, {"all_bn_cnt": "CNT"}, f"{BN} AND {OUT} AND {LATEST}"),
            self.part(k, {"all_bn_amt": "OD_AMT"}, f"{BN} AND {LATEST}"),
        )
        ordinal = ("cnt", "od_cnt", "bal", "od_amt")
        names = [f"{p}_{c}" for p in ("first", "repeat") for c in ordinal]
        names += ["all_cnt", "all_od_cnt", "all_bal", "all_od_amt"]
        names += ["all_bo_cnt", "all_bo_amt", "all_bn_cnt", "all_bn_amt"]
        return self.sql(
            f"SELECT PROV_CD AS code, NAME AS name, {', '.join(names)}, "
            f"{self.rate('first_od_amt', 'first_bal')} AS first_od_rate, "
            f"{self.rate('repeat_od_amt', 'repeat_bal')} AS repeat_od_rate, "
            f"{self.rate('all_od_amt', 'all_bal')} AS all_od_rate, "
            f"{self.rate('all_bo_amt', 'all_bal')} AS all_bo_rate, "
            f"{self.rate('all_bn_amt', 'all_bal')} AS all_bn_rate FROM {self.named('t', k)}",
            f"a AS ({self._ordinal(k, 'first', 'RELOAN = 1', LATEST)})",
            f"b AS ({self._ordinal(k, 'repeat', 'RELOAN <> 1', LATEST)})",
            f"c AS ({every})",
            f"f AS (SELECT PROV_CD, {self.fill(*names)} FROM a FULL OUTER JOIN b USING (PROV_CD) "
            "FULL OUTER JOIN c USING (PROV_CD))",
            f"t AS ({self.with_total('f', k, names)})",
        )

    def reloan_rate_by_date(self) -> str:
        k = "DATA_DT"
        m = self.outer(
            k,
            self.part(k, {"second_cnt": "CNT"}, "RELOANTIMES = 2"),
            self.part(k, {"settled_first_cnt": "CNT"}, "RELOANTIMES = 1 AND OVERDUE_STATUS_3 = 2"),
        )
        return self.sql(
            f"SELECT {self.key()} AS data_dt, second_cnt, settled_first_cnt, "
            f"{self.rate('second_cnt', 'settled_first_cnt')} AS reloan_rate FROM m",
            f"m AS ({m})",
        )

    def reloan_rate_by_province(self) -> str:
        k = "PROV_CD, DATA_DT"
        m = self.outer(
            k,
            self.part(k, {"second_cnt": "CNT"}, "RELOANTIMES = 2"),
            self.part(k, {"settled_first_cnt": "CNT"}, "RELOANTIMES = 1 AND OVERDUE_STATUS_3 = 2"),
        )
        return self.sql(
            f"SELECT PROV_CD AS code, NAME AS name, {self.key()} AS data_dt, second_cnt, settled_first_cnt, "
            f"{self.rate('second_cnt', 'settled_first_cnt')} AS reloan_rate FROM {self.named('f', 'PROV_CD')}",
            f"m AS ({m})",
            f"f AS (SELECT PROV_CD, DATA_DT, {self.fill('second_cnt', 'settled_first_cnt')} FROM m)",
        )

    def reloan_new_vs_cumulative(self) -> str:
        return self.sql(
            "SELECT * FROM a FULL OUTER JOIN b USING (data_dt)",
            f"a AS (SELECT {self.key('BEGIN_DATE')} AS data_dt, CAST(sum(CNT) AS BIGINT) AS new_cnt, "
            "CAST(sum(LOAN_PR) AS BIGINT) AS new_loan_pr FROM facts WHERE NEW_LOAN = 1 AND RELOAN > 1 GROUP BY 1)",
            f"b AS (SELECT {self.key()} AS data_dt, CAST(sum(CNT) AS BIGINT) AS cum_cnt, "
            "CAST(sum(LOAN_PR) AS BIGINT) AS cum_loan_pr FROM facts WHERE RELOANTIMES <> 1 GROUP BY 1)",
        )

    # -- lending -----------------------------------------------------------

    def _lending(self, k: str) -> str:
        m = self.outer(
            k,
            self.part(k, {"cnt": "CNT", "loan_pr": "LOAN_PR", "bal": "BAL"}, LATEST),
            self.part(k, {"out_cnt": "CNT"}, f"{OUT} AND {LATEST}"),
        )
        names = ["cnt", "loan_pr", "out_cnt", "bal"]
        return self.sql(
            f"SELECT {k} AS code, NAME AS name, {', '.join(names)} FROM {self.named('t', k)}",
            f"m AS ({m})",
            f"f AS (SELECT {k}, {self.fill(*names)} FROM m)",
            f"t AS ({self.with_total('f', k, names)})",
        )

    def lending_by_province(self) -> str:
        return self._lending("PROV_CD")

    def lending_by_city(self) -> str:
        return self._lending("SHENGSHI_CD")

    def lending_by_date(self) -> str:
        k = "DATA_DT"
        m = self.outer(
            k,
            self.part(k, {"new_cnt": "CNT", "new_amt": "NEW_AMT"}, "NEW_LOAN = 1"),
            self.part(k, {"cum_loan_pr": "LOAN_PR", "cum_cnt": "CNT"}),
        )
        return self.sql(
            f"SELECT {self.key()} AS data_dt, new_cnt, new_amt, cum_loan_pr, cum_cnt FROM m", f"m AS ({m})"
        )

    def repayment(self) -> str:
        k = "DATA_DT"
        touched = f"({OD} OR OVERDUE_STATUS_3_LAST = 1)"
        m = self.outer(
            k,
            self.part(k, {"sp_amt": "DIFF_SP_AMT"}),
            self.part(k, {"ap_amt": "DIFF_AP_AMT"}),
            self.part(k, {"od_sp_amt": "DIFF_SP_AMT"}, touched),
            self.part(k, {"od_ap_amt": "DIFF_AP_AMT"}, touched),
        )
        title = "CAST(month(DATA_DT) AS VARCHAR) || '月回款'" if self.monthly else f"{self.key()} || '回款'"
        return self.sql(
            f"SELECT {title} AS title, {self.span()} AS data_dt, sp_amt, ap_amt, od_sp_amt, od_ap_amt FROM m",
            f"m AS ({m})",
        )

    def termination_maturity(self) -> str:
        k = "DATA_DT"
        matured = f"MATURITY_DAYS <> -1 AND {OUT}"
        m = self.outer(
            k,
            self.part(k, {"od_cnt": "CNT"}, OD),
            self.part(k, {"od_amt": "OD_AMT"}, OD),
            self.part(k, {"matured_cnt": "CNT"}, matured),
            self.part(k, {"matured_od_amt": "OD_AMT"}, matured),
            self.part(k, {"terminated_cnt": "CNT"}, "STATUS_THIS_MONTH = 1"),
            self.part(k, {"terminated_od_amt": "OD_AMT"}, "STATUS_THIS_MONTH = 1"),
        )
        return self.sql(
            f"SELECT {self.key()} AS data_dt, od_cnt, od_amt, matured_cnt, matured_od_amt, "
            "terminated_cnt, terminated_od_amt FROM m",
            f"m AS ({m})",
        )

    # -- structure ---------------------------------------------------------

    def _stock(self, measure: str = "CNT", prefix: str = "cnt", states=range(5)) -> str:
        k = "DATA_DT"
        return self.outer(
            k, *[self.part(k, {f"{prefix}_{s}": measure}, f"OVERDUE_STATUS_5 = {s}") for s in states]
        )

    def state_stock(self) -> str:
        counts = [f"cnt_{s}" for s in range(5)]
        shown = ", ".join(counts) if self.cadence == "day" else self.fill(*counts)
        return self.sql(
            f"SELECT {self.key()} AS data_dt, {shown}, coalesce(m.cnt_0, 0) + coalesce(m.cnt_1, 0) AS regular FROM m",
            f"m AS ({self._stock()})",
        )

    def structure_count_share(self) -> str:
        counts = [f"cnt_{s}" for s in range(5)]
        whole = "cnt_0 + cnt_1 + cnt_2 + cnt_3 + cnt_4"
        return self.sql(
            f"SELECT {self.key()} AS data_dt, {self.rate('(cnt_0 + cnt_1)', f'({whole})')} AS normal_share, "
            f"{self.rate('cnt_2', f'({whole})')} AS ordinary_share, "
            f"{self.rate('cnt_3', f'({whole})')} AS collection_share, "
            f"{self.rate('cnt_4', f'({whole})')} AS serious_share FROM f",
            f"m AS ({self._stock()})",
            f"f AS (SELECT DATA_DT, {', '.join(counts) if self.cadence == 'day' else self.fill(*counts)} FROM m)",
        )

    def structure_amount_share(self) -> str:
        amounts = [f"od_amt_{s}" for s in (2, 3, 4)]
        whole = "(od_amt_2 + od_amt_3 + od_amt_4)"
        return self.sql(
            f"SELECT {self.key()} AS data_dt, {self.rate('od_amt_2', whole)} AS ordinary_share, "
            f"{self.rate('od_amt_3', whole)} AS collection_share, "
            f"{self.rate('od_amt_4', whole)} AS serious_share FROM f",
            f"m AS ({self._stock('OD_AMT', 'od_amt', (2, 3, 4))})",
            f"f AS (SELECT DATA_DT, {self.fill(*amounts)} FROM m)",
        )

    def structure_detail(self, true_increments: bool = True) -> str:
        measures = ["cnt", "od_principal", "od_amt", "bal"]
        sums = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in measures)
        parts = [
            "SELECT DATA_DT, CASE status WHEN 0 THEN '正常' WHEN 2 THEN '一般' WHEN 3 THEN '催收' WHEN 4 THEN '严重' END "
            f"AS status, {', '.join('g.' + m for m in measures)}, {self.rate('g.cnt', 's.cnt')} AS cnt_share, "
            f"{self.rate('g.bal', 's.bal')} AS bal_share FROM g JOIN s USING (DATA_DT)",
            f"SELECT DATA_DT, '汇总', {', '.join(measures)}, {self.rate('cnt', 'cnt')}, {self.rate('bal', 'bal')} FROM s",
        ]
        if self.cadence != "day":
            change = [f"b.{m} - a.{m}" if true_increments else f"b.{m}" for m in measures]
            parts.append(
                f"SELECT b.DATA_DT, '增量', {', '.join(change)}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) "
                "FROM n b JOIN n a ON b.pos = a.pos + 1"
            )
        union = "\n  UNION ALL ".join(parts)
        return self.sql(
            f"SELECT {self.key()} AS data_dt, status, {', '.join(measures)}, cnt_share, bal_share FROM u",
            f"k AS (SELECT DATA_DT, CASE WHEN OVERDUE_STATUS_5 IN (0, 1) THEN 0 ELSE OVERDUE_STATUS_5 END AS status, "
            f"CNT, OD_PRINCIPAL, OD_AMT, BAL FROM facts WHERE {OUT} AND DATA_DT >= DATE '{DETAIL_FROM}')",
            f"g AS (SELECT DATA_DT, status, {sums} FROM k GROUP BY DATA_DT, status)",
            f"s AS (SELECT DATA_DT, {sums} FROM k GROUP BY DATA_DT)",
            "n AS (SELECT *, row_number() OVER (ORDER BY DATA_DT) AS pos FROM s)",
            f"u AS ({union})",
        )

    def structure_detail_as_written(self) -> str:
        return self.structure_detail(true_increments=False)

    # -- light -------------------------------------------------------------

    def _light(self, k: str, also: str = "TRUE") -> tuple[str, list[str], str]:
        lights = {"all": "TRUE", "yellow": "LIGHT = 1", "green": "LIGHT = 0"}
        parts, names, rates = [], [], []
        for light, which in lights.items():
            where = f"{OUT} AND {which} AND {also}"
            parts.append(self.part(k, {f"{light}_cnt": "CNT", f"{light}_bal": "BAL"}, where))
            parts.append(
                self.part(k, {f"{light}_od_cnt": "CNT", f"{light}_od_amt": "OD_AMT"}, f"{where} AND {OD}")
            )
            names += [f"{light}_{m}" for m in ("cnt", "bal", "od_cnt", "od_amt")]
            rates.append(f"{self.rate(f'{light}_od_amt', f'{light}_bal')} AS {light}_od_rate")
        return self.outer(k, *parts), names, ", ".join(rates)

    def light_by_date(self) -> str:
        m, names, rates = self._light("DATA_DT")
        return self.sql(
            f"SELECT {self.key()} AS data_dt, {', '.join(names)}, {rates} FROM f",
            f"m AS ({m})",
            f"f AS (SELECT DATA_DT, {self.fill(*names)} FROM m)",
        )

    def light_by_province(self) -> str:
        newest = f"DATA_DT = (SELECT max(DATA_DT) FROM facts WHERE {OUT})"
        m, names, rates = self._light("PROV_CD", newest)
        return self.sql(
            f"SELECT PROV_CD AS code, NAME AS name, {', '.join(names)}, {rates} FROM {self.named('f', 'PROV_CD')}",
            f"m AS ({m})",
            f"f AS (SELECT PROV_CD, {self.fill(*names)} FROM m)",
        )

    # -- migration ---------------------------------------------------------

    def _fund_change(self, new: str, moved: str) -> tuple[str, list[str]]:
        k, names, parts = "DATA_DT", [], []
        for status, name in ((0, "new_normal"), (1, "new_overdue")):
            parts.append(self.part(k, {name: new}, f"NEW_LOAN = 1 AND OVERDUE_STATUS_3 = {status}"))
            names.append(name)
        for a in (0, 1):
            for b in (0, 1, 2):
                names.append(f"t_{a}_{b}")
                parts.append(
                    self.part(k, {names[-1]: moved}, f"OVERDUE_STATUS_3_LAST = {a} AND OVERDUE_STATUS_3 = {b}")
                )
        names.append("newly_terminated")
        parts.append(self.part(k, {names[-1]: moved}, "STATUS_LAST_MONTH = 0 AND STATUS_THIS_MONTH = 1"))
        return self.outer(k, *parts), names

    def fund_change_count(self) -> str:
        m, names = self._fund_change("CNT", "CNT")
        return self.sql(
            f"SELECT {self.span()} AS data_dt, {', '.join(names)}, t_1_1 - newly_terminated AS diff FROM f",
            f"m AS ({m})",
            f"f AS (SELECT DATA_DT, {self.fill(*names)} FROM m)",
        )

    def fund_change_amount(self) -> str:
        m, names = self._fund_change("OD_AMT", "DIFF_OD_AMT")
        return self.sql(
            f"SELECT {self.span()} AS data_dt, {', '.join(names)}, t_1_1 - newly_terminated AS diff, "
            f"{' + '.join(names[:-1])} AS diff_amt FROM f",
            f"m AS ({m})",
            f"f AS (SELECT DATA_DT, {self.fill(*names)} FROM m)",
        )

    def migration_rates(self) -> str:
        k = "DATA_DT"
        flows = {
            "regular_to_late": "OVERDUE_STATUS_5_LAST IN (0, 1) AND OVERDUE_STATUS_5 NOT IN (0, 1)",
            "f_2_3": "OVERDUE_STATUS_5_LAST = 2 AND OVERDUE_STATUS_5 = 3",
            "f_2_4": "OVERDUE_STATUS_5_LAST = 2 AND OVERDUE_STATUS_5 = 4",
            "f_3_4": "OVERDUE_STATUS_5_LAST = 3 AND OVERDUE_STATUS_5 = 4",
            "f_4_4": "OVERDUE_STATUS_5_LAST = 4 AND OVERDUE_STATUS_5 = 4",
        }
        bases = {"regular_to_late": "p_0 + p_1", "f_2_3": "p_2", "f_2_4": "p_2", "f_3_4": "p_3", "f_4_4": "p_4"}
        moved = self.outer(k, *[self.part(k, {n: "CNT"}, w) for n, w in flows.items()])
        days = [p.day for p in periods(self.cadence)]
        pairs = ", ".join(f"(DATE '{b}', DATE '{a}')" for a, b in zip(days, days[1:]))
        prior = ", ".join(f"coalesce(cnt_{s}, 0) AS p_{s}" for s in range(5))
        rates = ", ".join(f"{self.rate(n, f'({b})')} AS {n}_rate" for n, b in bases.items())
        return self.sql(
            f"SELECT {self.span()} AS data_dt, {', '.join(flows)}, {rates} FROM f",
            f"v AS ({moved})",
            f"s AS ({self._stock()})",
            f"pairs(DATA_DT, prior_dt) AS (VALUES {pairs})",
            f"f AS (SELECT v.DATA_DT, {self.fill(*flows)}, {prior} FROM v JOIN pairs USING (DATA_DT) "
            "JOIN s ON s.DATA_DT = pairs.prior_dt)",
        )

    # -- vintage -----------------------------------------------------------

    def _vintage(self, measure: str, which: str, as_rate: bool) -> str:
        days = [p.day for p in periods(self.cadence)]
        ages = range((days[-1].year * 12 + days[-1].month) - (days[0].year * 12 + days[0].month) + 1)
        k = "BEGIN_DATE"
        begun = "BEGIN_DATE >= (SELECT min(DATA_DT) FROM facts)"
        cells = self.outer(
            k, *[self.part(k, {f"m{a}": measure}, f"{begun} AND {which} AND LOAN_M_CNT = {a}") for a in ages]
        )
        shown = ", ".join(f"{self.rate(f'm{a}', 'new_amt')} AS m{a}" if as_rate else f"m{a}" for a in ages)
        return self.sql(
            f"SELECT strftime(BEGIN_DATE, '%Y-%m') AS begin_month, new_amt, {shown} FROM n RIGHT JOIN c USING (BEGIN_DATE)",
            f"n AS {self.part(k, {'new_amt': 'NEW_AMT'}, which)}",
            f"c AS ({cells})",
        )

    def vintage_amount(self) -> str:
        return self._vintage("OD_AMT", "TRUE", False)

    def vintage_rate(self) -> str:
        return self._vintage("OD_AMT", "TRUE", True)

    # -- 30-day family -----------------------------------------------------

    def month_30_index(self, overdue: str, lent: str, first_bn: str = "RELOAN <> 1") -> str:
        k, s = "DATA_DT", "OVERDUE_STATUS_3_30"

        def block(who: str, which: str, bn: str) -> str:
            return self.outer(
                k,
                self.part(k, {f"{who}_cnt": "CNT"}, f"{which} AND {s} <> 2"),
                self.part(k, {f"{who}_od_cnt": "CNT"}, f"{which} AND {s} = 1"),
                self.part(k, {f"{who}_lent": lent}, which),
                self.part(k, {f"{who}_od_amt": overdue}, which),
                self.part(k, {f"{who}_bn_amt": overdue}, f"{bn} AND {BN}"),
            )

        names = [f"{w}_{c}" for w in ("first", "repeat", "all") for c in ("cnt", "od_cnt", "lent", "od_amt", "bn_amt")]
        rates = ", ".join(
            f"{self.rate(f'{w}_{c}_amt', f'{w}_lent')} AS {w}_{c}_rate"
            for w in ("first", "repeat", "all")
            for c in ("od", "bn")
        )
        return self.sql(
            f"SELECT strftime(DATA_DT, '%Y-%m') AS data_dt, {', '.join(names)}, {rates} FROM f",
            f"a AS ({block('first', 'RELOAN = 1', first_bn)})",
            f"b AS ({block('repeat', 'RELOAN <> 1', 'RELOAN <> 1')})",
            f"c AS ({block('every', 'TRUE', 'TRUE').replace('every_', 'all_')})",
            f"f AS (SELECT DATA_DT, {self.fill(*names)} FROM a FULL OUTER JOIN b USING (DATA_DT) "
            "FULL OUTER JOIN c USING (DATA_DT))",
        )

    def month_30_vintage(self, overdue: str, repeats: bool, as_rate: bool) -> str:
        return self._vintage(overdue, "BRELOAN <> 1" if repeats else "TRUE", as_rate)


# -- bundles -----------------------------------------------------------------

# Where the workbook has its tables, one line a table or text cell, in the order of
# writing: sheet | table or "text" | first row | first column | columns | header.  Names in the first row or column
# stand for the rows or columns of that table.
WORKBOOK = """
资金变化 | fund_change_count | 2 | 1 | 11 | no
资金变化 | "金额" | 2 + fund_change_count | 1 | 1 | no
资金变化 | fund_change_amount | 3 + fund_change_count | 1 | 12 | no
续贷逾期情况 | reloan_overdue_by_date | 4 | 1 | 20 | no
续贷逾期情况 | reloan_overdue_by_province | 6 + reloan_overdue_by_date | 1 | 23 | yes
还款情况 | repayment | 3 | 1 | 6 | no
迁徙率月度情况 | state_stock | 2 | 1 | 7 | no
迁徙率月度情况 | migration_rates | 2 | 1 + state_stock | 11 | no
资产情况月度分析 | vintage_amount | 3 | 1 | ages | yes
资产情况月度分析 | vintage_rate | 4 + vintage_amount | 1 | ages | yes
终止和到期情况 | termination_maturity | 4 | 1 | 7 | no
资产结构类数据 | structure_count_share | 2 | 1 | 5 | yes
资产结构类数据 | "金额比" | 3 + structure_count_share | 1 | 1 | no
资产结构类数据 | structure_amount_share | 4 + structure_count_share | 1 | 4 | yes
资产结构类数据 | structure_detail | 6 + structure_count_share + structure_count_share | 1 | 8 | yes
放款情况 | lending_by_province | 2 | 1 | 6 | no
放款情况 | lending_by_city | 2 | 11 | 6 | no
放款情况 | lending_by_date | 25 | 3 | 5 | yes
逾期率及不良率 | overdue_by_date | 2 | 1 | 14 | no
逾期率及不良率 | overdue_by_province | 4 + overdue_by_date | 1 | 15 | yes
逾期率及不良率 | overdue_by_city | 6 + overdue_by_date + overdue_by_province | 1 | 7 | yes
逾期率及不良率 | overdue_by_scope | 3 | 19 | 6 | no
黄绿灯逾期（历史值） | light_by_date | 3 | 4 | 16 | no
黄绿灯逾期（历史值） | light_by_province | 5 + light_by_date | 4 | 17 | yes
续贷情况（历史值） | reloan_rate_by_date | 3 | 1 | 4 | no
续贷情况（历史值） | reloan_rate_by_province | 3 | 11 | 6 | no
续贷情况（历史值） | "借据号概念" | 5 + reloan_rate_by_date | 1 | 1 | no
续贷情况（历史值） | reloan_new_vs_cumulative | 6 + reloan_rate_by_date | 1 | 5 | yes
"""

# What the workbooks of shorter cadences leave out.
NOT_IN_WEEK = ("vintage_amount", "vintage_rate")
NOT_IN_DAY = (*NOT_IN_WEEK, "fund_change_count", "金额", "fund_change_amount", "migration_rates")
LEFT_OUT = {"month": (), "week": NOT_IN_WEEK, "biweek": NOT_IN_WEEK, "day": NOT_IN_DAY}


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def _counts(tables: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS t, CAST(count(*) AS INTEGER) AS n FROM ({sql})" for n, sql in tables.items())
    return f"counts AS MATERIALIZED ({rows})"


def _rows_of(table: str) -> str:
    return f"(SELECT n FROM counts WHERE t = '{table}')"


def _manifest(lines: list[tuple]) -> str:
    """Rows of (sheet, table, text, start row, start column, columns, header, rows) as SQL, numbered."""
    return " UNION ALL ".join(
        f"SELECT {seq} AS seq, '{sheet}' AS sheet, {_text(table)} AS \"table\", {_text(text)} AS text, "
        f"{row} AS start_row, {column} AS start_column, {columns} AS n_columns, {header} AS header, {n} AS n_rows"
        for seq, (sheet, table, text, row, column, columns, header, n) in enumerate(lines, 1)
    )


def workbook(cadence: str) -> str:
    """The manifest of a cadence's workbook; only row counts depend on the data, and each comes from its report's SQL."""
    reports, width, lines, tables = Reports(cadence), {}, [], {}
    days = [p.day for p in periods(cadence)]
    ages = (days[-1].year * 12 + days[-1].month) - (days[0].year * 12 + days[0].month) + 1
    for line in WORKBOOK.strip().splitlines():
        sheet, name, row, column, columns, header = (x.strip() for x in line.split("|"))
        text = name.strip('"') if name.startswith('"') else None
        if (text or name) in LEFT_OUT[cadence]:
            continue
        width[name] = columns = 2 + ages if columns == "ages" else int(columns)
        if not text:
            tables[name] = getattr(reports, name)()
        start = " + ".join(x.strip() if x.strip().isdigit() else _rows_of(x.strip()) for x in row.split("+"))
        first = sum(int(x) if x.strip().isdigit() else width[x.strip()] for x in column.split("+"))
        n = "1" if text else _rows_of(name)
        lines.append((sheet, None if text else name, text, start, first, columns, str(header == "yes").upper(), n))
    return f"WITH {_counts(tables)} {_manifest(lines)}"


# -- 30-day workbook -----------------------------------------------------------

# Its four runs (population, overdue amount, lending) and the tables on each run's second sheet.
RUNS_30 = (
    ("all", "OD_AMT_30", "LOAN_PR_FEE"),
    ("all", "OD_PRINCIPAL_30", "LOAN_PR"),
    ("excl_code", "OD_AMT_30", "LOAN_PR_FEE"),
    ("excl_code", "OD_PRINCIPAL_30", "LOAN_PR"),
)
STACK_30 = ("vintage_amount", "vintage_rate", "reloan_vintage_amount", "reloan_vintage_rate")
AGES_30 = 7


def _tables_30() -> dict[str, str]:
    out = {}
    for n, (population, overdue, lent) in enumerate(RUNS_30, 1):
        reports = Reports("month", population)
        out[f"overdue_index_{n}"] = reports.month_30_index(overdue, lent)
        for name in STACK_30:
            out[f"{name}_{n}"] = reports.month_30_vintage(overdue, name.startswith("reloan"), name.endswith("rate"))
    return out


def _starts_30(n: int) -> dict[str, str]:
    """First rows on a run's second sheet: 3, then each table's rows and 3 more."""
    starts, row = {}, "3"
    for name in STACK_30:
        starts[name] = row
        row = f"{row} + {_rows_of(f'{name}_{n}')} + 3"
    return starts


def workbook_30() -> str:
    lines = [(f"逾期情况{n}", f"overdue_index_{n}", None, "4", 1, 22, "FALSE", _rows_of(f"overdue_index_{n}")) for n in (1, 2, 3, 4)]
    for n in (1, 2, 3, 4):
        for name, start in _starts_30(n).items():
            if name == "reloan_vintage_amount":
                lines.append((f"资产情况{n}", None, "续贷资产情况", f"{start} - 1", 1, 1, "FALSE", "1"))
            lines.append((f"资产情况{n}", f"{name}_{n}", None, start, 1, 2 + AGES_30, "TRUE", _rows_of(f"{name}_{n}")))
    return f"WITH {_counts(_tables_30())} {_manifest(lines)}"


def sheets_30() -> str:
    """Every row of the 30-day sheets, cells as text between bars."""
    who = {
        "first": ("cnt", "od_cnt", "lent", "od_amt", "bn_amt"),
        "repeat": ("cnt", "od_cnt", "lent", "od_amt", "bn_amt"),
        "all": ("cnt", "od_cnt", "od_amt", "bn_amt", "lent"),
    }
    index = ["data_dt", *(f"{w}_{c}" for w, cs in who.items() for c in (*cs, "od_rate", "bn_rate"))]
    cohort = ["begin_month", "new_amt", *(f"m{a}" for a in range(AGES_30))]
    labels = "|".join(["新增放款月份", "新增放款金额", "当月", *(f"第{a}个月" for a in range(2, AGES_30 + 1))])

    def cells(columns: list[str], rates: bool) -> str:
        def shown(c: str) -> str:
            percent = c.endswith("_rate") or rates and c[0] == "m"
            value = f"CASE WHEN {c} IS NOT NULL THEN printf('%.2f%%', 100 * {c}) END" if percent else f"CAST({c} AS VARCHAR)"
            return f"coalesce({value}, '')"

        return " || '|' || ".join(map(shown, columns))

    def body(sheet: str, block: int, top: str, order: str, columns: list[str], rates: bool, table: str) -> str:
        return (
            f"SELECT '{sheet}' AS sheet, {block} AS block, 'body' AS kind, "
            f"CAST({top} + row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS row, {cells(columns, rates)} AS cells FROM {table}"
        )

    tables = _tables_30()
    named = ", ".join(f"t_{n} AS MATERIALIZED ({sql})" for n, sql in tables.items())
    parts = [body(f"逾期情况{n}", 1, "4", "data_dt", index, False, f"t_overdue_index_{n}") for n in (1, 2, 3, 4)]
    for n in (1, 2, 3, 4):
        for block, (name, start) in enumerate(_starts_30(n).items(), 1):
            sheet = f"资产情况{n}"
            parts.append(f"SELECT '{sheet}', {block}, 'header', CAST({start} AS INTEGER), '{labels}'")
            if name == "reloan_vintage_amount":
                parts.append(f"SELECT '{sheet}', {block}, 'heading', CAST({start} - 1 AS INTEGER), '续贷资产情况'")
            parts.append(body(sheet, block, f"{start} + 1", "begin_month", cohort, name.endswith("rate"), f"t_{name}_{n}"))
    counts = " UNION ALL ".join(f"SELECT '{n}' AS t, CAST(count(*) AS INTEGER) AS n FROM t_{n}" for n in tables)
    return f"WITH {named}, counts AS MATERIALIZED ({counts}) {' UNION ALL '.join(parts)}"
