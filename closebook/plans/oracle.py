"""DuckDB oracle: the SQL equivalent of every catalog entry.

Written directly against the raw testdata tables (pre-registered views
``lineitem``, ``orders``, ...). Conventions shared with the Spark side:
``ROUND(x, n) + 0.0`` (DuckDB keeps -0.0, Spark does not), ``NULLIF`` on every
denominator, explicit DOUBLE literals, INTEGER calendar parts.
"""

from __future__ import annotations

from closebook.functions import constants as K
from closebook.plans.catalog import PARAMS

Y = PARAMS["year"]
Y1 = Y - 1


def R(x: str, n: int) -> str:
    return f"(ROUND({x}, {n}) + 0.0)"


def PCT(num: str, den: str, n: int = 1) -> str:
    return R(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * CAST(100.0 AS DOUBLE)", n)


def MS(x: str) -> str:
    """Exact sum of line amounts."""
    return f"SUM(CAST({x} AS DECIMAL(18,4)))"


def DR(x: str, n: int) -> str:
    """Exact decimal rounding reported as DOUBLE."""
    return f"CAST(ROUND({x}, {n}) AS DOUBLE)"


def MIL(x: str) -> str:
    return f"({x}) * CAST(0.000001 AS DECIMAL(7,6))"


def DIV(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


def D(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def S(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def IN(vals) -> str:
    return "(" + ", ".join(S(v) if isinstance(v, str) else str(v) for v in vals) + ")"


def WITH(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------------------
# shared CTEs
# --------------------------------------------------------------------------

OC = """oc AS (
  SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date,
         c.c_mktsegment AS ch
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

SALES = OC + """,
sales AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
         oc.order_date,
         strftime(oc.order_date, '%Y-%m') AS ym,
         CAST(year(oc.order_date) AS INTEGER) AS yr,
         CAST(month(oc.order_date) AS INTEGER) AS mo,
         CAST(quarter(oc.order_date) AS INTEGER) AS qtr,
         l.l_partkey AS sku, p.p_type AS cat, p.p_brand AS collection, oc.ch,
         l.l_quantity AS qty,
         l.l_extendedprice * (1 - l.l_discount) AS revenue,
         l.l_quantity * p.p_retailprice AS cost,
         l.l_extendedprice * (1 - l.l_discount) - l.l_quantity * p.p_retailprice AS margin
  FROM lineitem l
  LEFT JOIN oc ON l.l_orderkey = oc.order_id
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

CUBE = SALES + """,
cube AS (
  SELECT ym, yr, mo, ch, cat, SUM(qty) AS qty, """ + MS("revenue") + """ AS revenue,
         """ + MS("cost") + " AS cost, " + MS("margin") + """ AS margin
  FROM sales GROUP BY ym, yr, mo, ch, cat)"""

CMART = """coll AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber, l.l_partkey, l.l_suppkey,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(GREATEST(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)), 0)
              AS INTEGER) AS delay_days,
         l.l_extendedprice AS amount
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
coll2 AS (SELECT *, order_date + delay_days AS settle_date FROM coll),
lookup AS (
  SELECT o.o_orderkey AS order_id, c.c_mktsegment AS ch
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
cmart AS (
  SELECT coll2.*, lookup.ch, strftime(coll2.order_date, '%Y-%m') AS ym
  FROM coll2 LEFT JOIN lookup ON coll2.order_id = lookup.order_id)"""

rules = ", ".join(f"({S(c)}, {D(t)}, {S(lab)})" for c, t, lab in PARAMS["dso_rules"])
DSO = CMART + f""",
dso AS (
  SELECT ym, ch, COUNT(*) AS n, {R('AVG(delay_days)', 1)} AS dso_days,
         {DR(MS('amount') + ' * CAST(0.001 AS DECIMAL(4,3))', 0)} AS collected_k, {MS('amount')} AS amount
  FROM cmart WHERE ym IS NOT NULL GROUP BY ym, ch),
dsow AS (
  SELECT *,
    {R('AVG(dso_days) OVER (PARTITION BY ch ORDER BY ym ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 1)} AS dso_avg3,
    dso_days - LAG(dso_days, 1) OVER (PARTITION BY ch ORDER BY ym) AS mom,
    {R('dso_days - LAG(dso_days, 12) OVER (PARTITION BY ch ORDER BY ym)', 1)} AS yoy
  FROM dso),
rules AS (SELECT * FROM (VALUES {rules}) AS r(ch, threshold, label)),
dsoa AS (
  SELECT d.*, CASE WHEN d.dso_days > r.threshold THEN r.label END AS alert
  FROM dsow d LEFT JOIN rules r ON d.ch = r.ch)"""

CHM = """charges AS (
  SELECT CAST(l.l_shipdate AS DATE) AS charge_date, printf('CC%02d', s.s_nationkey) AS cc_id,
         l.l_returnflag AS nature, l.l_extendedprice * l.l_tax AS amount
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
chm AS (
  SELECT strftime(charge_date, '%Y-%m') AS ym, cc_id, nature, """ + MS("amount") + """ AS amount
  FROM charges GROUP BY 1, 2, 3)"""

CC = """cc AS (
  SELECT printf('CC%02d', n.n_nationkey) AS cc_id, n.n_name AS cc_name,
         COALESCE(p.payroll_base, 0.0) AS payroll_base
  FROM nation n LEFT JOIN (
    SELECT s_nationkey, SUM(s_acctbal) AS payroll_base FROM supplier GROUP BY s_nationkey) p
  ON n.n_nationkey = p.s_nationkey)"""

ZS = CHM + ",\n" + CC + f""",
base AS (
  SELECT *,
    AVG(CAST(amount AS DOUBLE)) OVER (PARTITION BY cc_id, nature ORDER BY ym ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS mean12,
    STDDEV_SAMP(CAST(amount AS DOUBLE)) OVER (PARTITION BY cc_id, nature ORDER BY ym ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS std12
  FROM chm),
zs0 AS (SELECT *, {DIV('amount - mean12', 'std12')} AS zz FROM base),
zs AS (
  SELECT z.ym, z.cc_id, cc.cc_name, z.nature,
         {DR('z.amount', 0)} AS amount, {R('z.mean12', 0)} AS mean,
         {R('z.amount - z.mean12', 0)} AS var_value,
         {PCT('z.amount - z.mean12', 'z.mean12')} AS var_pc,
         {R('z.zz', 2)} AS z,
         CASE WHEN ABS(z.zz) > {D(K.Z_MAJOR)} THEN {S(K.SEVERITY_LABELS['major'])}
              WHEN ABS(z.zz) > {D(K.Z_SIGNIFICANT)} THEN {S(K.SEVERITY_LABELS['significant'])}
              ELSE {S(K.SEVERITY_LABELS['normal'])} END AS severity,
         z.mean12 AS _mean, z.zz AS _z
  FROM zs0 z LEFT JOIN cc USING (cc_id))"""

coef_rows = ", ".join(f"({m}, {D(K.SEASONALITY[m])})" for m in range(1, 13))
COEF = f"coef AS (SELECT * FROM (VALUES {coef_rows}) AS c(mo, coef))"
MONTHS = "months AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS mo)"

BUDGET = CUBE + ",\n" + CHM + ",\n" + COEF + ",\n" + MONTHS + f""",
bbase AS (
  SELECT ch, cat, {MS('revenue')} AS rev, {MS('margin')} AS mar FROM sales
  WHERE yr = {Y1} AND ch IS NOT NULL AND cat IS NOT NULL GROUP BY ch, cat),
bcells AS (
  SELECT ch, cat,
    CAST(SUM(rev) OVER () AS DOUBLE) * {D(1.0 + K.GROWTH_N)} AS target,
    {DIV('SUM(rev) OVER (PARTITION BY ch)', 'SUM(rev) OVER ()')} AS share_ch,
    {DIV('SUM(rev) OVER (PARTITION BY cat)', 'SUM(rev) OVER ()')} AS share_cat,
    {DIV('SUM(mar) OVER (PARTITION BY ch)', 'SUM(rev) OVER (PARTITION BY ch)')} AS margin_ch,
    {DIV('SUM(mar) OVER (PARTITION BY cat)', 'SUM(rev) OVER (PARTITION BY cat)')} AS margin_cat
  FROM bbase),
brev AS (
  SELECT {Y} AS yr, c.mo, 'CA' AS type, b.ch, b.cat,
         {R('b.target * b.share_ch * b.share_cat * c.coef / ' + D(12.0), 2)} AS amount,
         {R('(b.margin_ch + b.margin_cat) / ' + D(2.0), 4)} AS margin_pc
  FROM bcells b CROSS JOIN coef c),
bexp_base AS (
  SELECT cc_id, CAST(SUM(amount) AS DOUBLE) / {D(12.0)} AS base FROM chm WHERE ym LIKE '{Y1}%' GROUP BY cc_id),
bexp AS (
  SELECT {Y} AS yr, m.mo, 'Charges' AS type, b.cc_id,
         {R(f"b.base * {D(K.EXPENSE_INFLATION)} * CASE WHEN b.cc_id IN {IN(PARAMS['marketing_cc'])} AND m.mo IN {IN(K.MARKETING_PEAK_MONTHS)} THEN {D(K.MARKETING_PEAK)} ELSE {D(1.0)} END", 2)} AS amount
  FROM bexp_base b CROSS JOIN months m),
budget AS (
  SELECT yr, mo, type, ch, cat, CAST(NULL AS VARCHAR) AS cc_id, amount, margin_pc FROM brev
  UNION ALL
  SELECT yr, mo, type, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), cc_id, amount,
         CAST(NULL AS DOUBLE) FROM bexp),
cells AS (
  SELECT mo, ch, cat, amount AS budget_revenue, amount * margin_pc AS budget_margin
  FROM budget WHERE type = 'CA' AND yr = {Y})"""

ACT = f"""act AS (
  SELECT mo, ch, cat, {MS('revenue')} AS actual_revenue, {MS('margin')} AS actual_margin
  FROM sales WHERE yr = {Y} GROUP BY mo, ch, cat),
j AS (SELECT a.*, c.budget_revenue, c.budget_margin FROM act a
      LEFT JOIN cells c ON a.mo = c.mo AND a.ch = c.ch AND a.cat = c.cat)"""

_RATIO = DIV('actual_revenue - budget_revenue', 'budget_revenue')
STATUS = f"""CASE WHEN {_RATIO} < {D(K.STATUS_STRONG_UNDER)} THEN {S(K.STATUS_LABELS['strong_under'])}
       WHEN {_RATIO} < {D(K.STATUS_UNDER)} THEN {S(K.STATUS_LABELS['under'])}
       WHEN {_RATIO} > {D(K.STATUS_OVER)} THEN {S(K.STATUS_LABELS['over'])}
       ELSE {S(K.STATUS_LABELS['on_track'])} END"""

VARIANCE = BUDGET + ",\n" + ACT + f""",
variance AS (
  SELECT mo, ch, cat,
    {R('budget_revenue', 0)} AS budget_revenue, {DR('actual_revenue', 0)} AS actual_revenue,
    {R('actual_revenue - budget_revenue', 0)} AS var_revenue,
    {PCT('actual_revenue - budget_revenue', 'budget_revenue')} AS var_revenue_pc,
    {R('budget_margin', 0)} AS budget_margin, {DR('actual_margin', 0)} AS actual_margin,
    {R('actual_margin - budget_margin', 0)} AS var_margin,
    {PCT('actual_margin - budget_margin', 'budget_margin')} AS var_margin_pc,
    {STATUS} AS status
  FROM j)"""

PIVOT = CUBE + f""",
piv0 AS (
  SELECT cat,
    SUM(CASE WHEN yr = {Y} THEN qty END) AS qty_n, SUM(CASE WHEN yr = {Y1} THEN qty END) AS qty_1,
    {MS(f'CASE WHEN yr = {Y} THEN revenue END')} AS revenue_n,
    {MS(f'CASE WHEN yr = {Y1} THEN revenue END')} AS revenue_1,
    COUNT(CASE WHEN yr = {Y} THEN 1 END) AS rows_n, COUNT(CASE WHEN yr = {Y1} THEN 1 END) AS rows_1
  FROM sales WHERE yr IN ({Y}, {Y1}) GROUP BY cat),
piv AS (
  SELECT cat, qty_n, qty_1, {DIV('revenue_n', 'qty_n')} AS price_n,
         {DIV('revenue_1', 'qty_1')} AS price_1, revenue_n, revenue_1
  FROM piv0 WHERE rows_n > 0 AND rows_1 > 0 AND cat IS NOT NULL),
eff AS (
  SELECT *, revenue_n - revenue_1 AS total, (qty_n - qty_1) * price_1 AS volume,
         (price_n - price_1) * qty_n AS price
  FROM piv)"""

MART_COLS = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, order_date, ym, yr, "
             "mo, qtr, sku, cat, collection, ch, qty, revenue, cost, margin")


def _margin_pc(n):
    return PCT("margin", "revenue", n)


SQL: dict[str, str] = {}

SQL["table_row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}"
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"])

SQL["sales_mart"] = WITH(SALES) + f"SELECT {MART_COLS}, {_margin_pc(2)} AS margin_pc FROM sales"

SQL["pnl_monthly_cube"] = WITH(CUBE) + f"""SELECT ym, yr, mo, ch, cat, qty,
  {DR('revenue', 2)} AS revenue, {DR('cost', 2)} AS cost, {DR('margin', 2)} AS margin,
  {_margin_pc(2)} AS margin_pc FROM cube"""

SQL["collections_mart"] = WITH(CMART) + """SELECT order_id, l_linenumber, l_partkey, l_suppkey,
  order_date, delay_days, settle_date, amount, ch, ym FROM cmart"""

KPI = f"""SELECT v.ym, v.yr, v.mo, v.ch, v.cat, v.qty,
  {DR('v.revenue', 0)} AS revenue, {DR('v.cost', 0)} AS cost, {DR('v.margin', 0)} AS margin,
  {PCT('v.margin', 'v.revenue')} AS margin_pc,
  CASE WHEN v.yr = {Y} THEN {R('b.budget_revenue', 0)} END AS budget_revenue,
  CASE WHEN v.yr = {Y} THEN {R('b.budget_margin', 0)} END AS budget_margin,
  CASE WHEN v.yr = {Y} THEN {R('v.revenue - b.budget_revenue', 0)} END AS var_revenue,
  CASE WHEN v.yr = {Y} THEN {PCT('v.revenue - b.budget_revenue', 'b.budget_revenue')} END AS var_pc
FROM cube v LEFT JOIN cells b ON v.mo = b.mo AND v.ch = b.ch AND v.cat = b.cat"""
SQL["kpi_mart"] = WITH(BUDGET) + KPI
SQL["kpi_mart_preview"] = (WITH(BUDGET) + "SELECT * FROM (" + KPI
                           + ") ORDER BY ym NULLS LAST, ch NULLS LAST, cat NULLS LAST LIMIT 10")

SQL["pnl_monthly"] = WITH(CUBE) + f"""SELECT ym, ch, cat, qty,
  {DR('revenue', 0)} AS revenue, {DR('cost', 0)} AS cost, {DR('margin', 0)} AS margin,
  {PCT('margin', 'revenue')} AS margin_pc,
  {PCT('revenue', 'SUM(revenue) OVER (PARTITION BY ym)')} AS mix_share_pc
FROM cube ORDER BY ym, ch, cat"""

SQL["pnl_mix_share"] = WITH(CUBE) + f"""SELECT ym, ch, cat, {DR('revenue', 2)} AS revenue,
  {DR('SUM(revenue) OVER (PARTITION BY ym)', 2)} AS month_revenue,
  {PCT('revenue', 'SUM(revenue) OVER (PARTITION BY ym)')} AS mix_share_pc FROM cube"""


def _evolution(extra: str = "") -> str:
    return WITH(SALES) + f"""SELECT ym, {R('CAST(' + MIL(MS('revenue')) + ' AS DOUBLE)', 4)} AS revenue_m,
  {R('CAST(' + MIL(MS('margin')) + ' AS DOUBLE)', 4)} AS margin_m, {PCT(MS('margin'), MS('revenue'))} AS margin_pc
FROM sales WHERE yr = {Y} {extra} GROUP BY ym ORDER BY ym"""


SQL["monthly_evolution"] = _evolution()
SQL["pnl_channel_slice"] = _evolution(f"AND ch = {S(PARAMS['channel'])}")

SQL["category_split"] = WITH(SALES) + f"""SELECT cat, {R('CAST(' + MIL(MS('revenue')) + ' AS DOUBLE)', 4)} AS revenue_m,
  {PCT(MS('revenue'), 'SUM(' + MS('revenue') + ') OVER ()')} AS share_pc
FROM sales WHERE yr = {Y} GROUP BY cat ORDER BY revenue_m DESC"""

SQL["headline_kpis"] = WITH(SALES) + f""", k AS (
  SELECT {MS(f'CASE WHEN yr = {Y} THEN revenue END')} AS revenue,
         {MS(f'CASE WHEN yr = {Y} THEN cost END')} AS cost,
         {MS(f'CASE WHEN yr = {Y} THEN margin END')} AS margin,
         SUM(CASE WHEN yr = {Y} THEN qty END) AS qty,
         {MS(f'CASE WHEN yr = {Y1} THEN revenue END')} AS revenue_1,
         {MS(f'CASE WHEN yr = {Y1} THEN margin END')} AS margin_1
  FROM sales WHERE yr IN ({Y}, {Y1}))
SELECT {DR('revenue', 2)} AS revenue, {DR('cost', 2)} AS cost, {DR('margin', 2)} AS margin, qty,
  {PCT('revenue - revenue_1', 'revenue_1')} AS revenue_growth_pc,
  {PCT('margin - margin_1', 'margin_1')} AS margin_growth_pc,
  {R(DIV('margin', 'revenue') + ' * ' + D(100.0), 1)} AS margin_rate_pc,
  {R(DIV('margin', 'revenue') + ' * ' + D(100.0) + ' - ' + DIV('margin_1', 'revenue_1') + ' * ' + D(100.0), 1)} AS margin_rate_delta_pts
FROM k"""

SQL["filter_years"] = WITH(SALES) + "SELECT DISTINCT yr FROM sales ORDER BY yr DESC"
SQL["filter_channels"] = WITH(SALES) + "SELECT DISTINCT ch FROM sales ORDER BY ch"

SQL["budget_resolved"] = WITH(BUDGET) + f"""SELECT mo, ch, cat, {R('budget_revenue', 2)} AS budget_revenue,
  {R('budget_margin', 2)} AS budget_margin FROM cells"""

SQL["budget_variance"] = WITH(VARIANCE) + "SELECT * FROM variance"
SQL["budget_status_counts"] = WITH(VARIANCE) + "SELECT status, COUNT(*) AS n FROM variance GROUP BY status ORDER BY status"

SQL["budget_variance_monthly"] = WITH(BUDGET, ACT) + f"""SELECT mo,
  {R('CAST(' + MIL(MS('budget_revenue')) + ' AS DOUBLE)', 4)} AS budget_m,
  {R('CAST(' + MIL('SUM(actual_revenue)') + ' AS DOUBLE)', 4)} AS actual_m,
  {R('CAST(' + MIL(MS('actual_revenue - budget_revenue')) + ' AS DOUBLE)', 4)} AS var_m,
  {PCT(MS('actual_revenue - budget_revenue'), MS('budget_revenue'))} AS var_pc,
  CASE WHEN {MS('actual_revenue - budget_revenue')} >= 0 THEN 'favourable' ELSE 'unfavourable' END AS favourable
FROM j GROUP BY mo ORDER BY mo"""

SQL["pvm_yearly_base"] = WITH(SALES) + f"""SELECT yr, cat, SUM(qty) AS qty, {DR(MS('revenue'), 2)} AS revenue,
  {R(DIV(MS('revenue'), 'SUM(qty)'), 4)} AS avg_price FROM sales GROUP BY yr, cat"""

SQL["pvm_pivot"] = WITH(PIVOT) + f"""SELECT cat, qty_n, qty_1, {R('price_n', 4)} AS price_n,
  {R('price_1', 4)} AS price_1, {DR('revenue_n', 2)} AS revenue_n, {DR('revenue_1', 2)} AS revenue_1 FROM piv"""

SQL["pvm_effects"] = WITH(PIVOT) + f"""SELECT cat, {DR('revenue_1', 0)} AS revenue_1, {DR('revenue_n', 0)} AS revenue_n,
  {DR('total', 0)} AS total_var, {R('volume', 0)} AS volume, {R('price', 0)} AS price,
  {R('total - volume - price', 0)} AS mix FROM eff ORDER BY ABS(total) DESC"""

SQL["pvm_ratios"] = WITH(PIVOT) + f"""SELECT cat, {PCT('revenue_n - revenue_1', 'revenue_1')} AS growth_pc,
  {PCT('price_n - price_1', 'price_1')} AS price_pc, {PCT('qty_n - qty_1', 'qty_1')} AS volume_pc
FROM eff ORDER BY ABS(total) DESC"""


def _m(x):
    return R(f"({x}) / {D(1e6)}", 2)


SQL["pvm_effects_m"] = WITH(PIVOT) + f"""SELECT cat, {DR(MIL('revenue_1'), 2)} AS revenue_1_m, {DR(MIL('revenue_n'), 2)} AS revenue_n_m,
  {DR(MIL('total'), 2)} AS total_var_m, {_m('volume')} AS volume_m, {_m('price')} AS price_m,
  {_m('total - volume - price')} AS mix_m, {PCT('total', 'revenue_1')} AS growth_pc,
  {PCT('price_n - price_1', 'price_1')} AS price_pc, {PCT('qty_n - qty_1', 'qty_1')} AS volume_pc
FROM eff ORDER BY ABS(total) DESC"""

SQL["pvm_mix_by_sku"] = WITH(SALES) + f""", sku AS (
  SELECT cat, sku,
    SUM(CASE WHEN yr = {Y} THEN qty END) AS q_n, SUM(CASE WHEN yr = {Y1} THEN qty END) AS q_1,
    {MS(f'CASE WHEN yr = {Y} THEN revenue END')} AS r_n, {MS(f'CASE WHEN yr = {Y1} THEN revenue END')} AS r_1
  FROM sales WHERE yr IN ({Y}, {Y1}) AND cat IS NOT NULL GROUP BY cat, sku),
c AS (
  SELECT cat, SUM(q_n) AS qty_n, SUM(q_1) AS qty_1, SUM(r_n) AS revenue_n, SUM(r_1) AS revenue_1,
         SUM(({DIV('r_n', 'q_n')} - {DIV('r_1', 'q_1')}) * q_n) AS price_eff
  FROM sku GROUP BY cat),
e AS (
  SELECT cat, revenue_n - revenue_1 AS total,
         (qty_n - qty_1) * {DIV('revenue_1', 'qty_1')} AS volume,
         COALESCE(price_eff, 0.0) AS price
  FROM c WHERE revenue_n IS NOT NULL AND revenue_1 IS NOT NULL)
SELECT cat, {DR('total', 0)} AS total_var, {R('volume', 0)} AS volume, {R('price', 0)} AS price,
  {R('total - volume - price', 0)} AS mix FROM e ORDER BY ABS(total) DESC"""

SQL["dso_monthly"] = WITH(DSO) + "SELECT ym, ch, n, dso_days, collected_k FROM dso"
SQL["dso_trend"] = WITH(DSO) + "SELECT ym, ch, dso_days FROM dso"
SQL["dso_moving_avg"] = WITH(DSO) + "SELECT ym, ch, dso_days, dso_avg3 FROM dsow"
SQL["dso_mom"] = WITH(DSO) + "SELECT ym, ch, dso_days, mom FROM dsow"
SQL["dso_yoy"] = WITH(DSO) + "SELECT ym, ch, dso_days, yoy FROM dsow"
SQL["dso_alerts"] = WITH(DSO) + "SELECT ym, ch, dso_days, alert FROM dsoa"

_ch, _start, _thr = PARAMS["dso_check"]
SQL["dso_channel_check"] = WITH(CMART) + f"""SELECT ym, {R('AVG(delay_days)', 1)} AS dso_days,
  {R('AVG(delay_days)', 1)} > {D(_thr)} AS breach
FROM cmart WHERE ch = {S(_ch)} AND ym >= {S(_start)} GROUP BY ym ORDER BY ym"""

SQL["collection_delay"] = WITH(CMART) + """SELECT order_id, l_linenumber, l_partkey, l_suppkey,
  order_date, settle_date, delay_days FROM coll2"""

SQL["charges_monthly"] = WITH(CHM) + f"SELECT ym, cc_id, nature, {DR('amount', 2)} AS amount FROM chm"
SQL["charges_baseline"] = WITH(ZS) + f"""SELECT ym, cc_id, nature, {DR('amount', 2)} AS amount,
  {R('mean12', 2)} AS mean12, {R('std12', 2)} AS std12 FROM base"""
SQL["charge_zscores"] = WITH(ZS) + """SELECT ym, cc_id, cc_name, nature, amount, mean, var_value,
  var_pc, z, severity FROM zs"""
SQL["charge_alerts_top20"] = WITH(ZS) + f"""SELECT ym, cc_id, cc_name, nature, amount, mean, var_value,
  var_pc, z, severity FROM zs WHERE _mean IS NOT NULL AND ABS(_z) > {D(K.Z_SIGNIFICANT)}
ORDER BY ym DESC, ABS(z) DESC, cc_id, nature LIMIT 20"""
SQL["charge_alerts_top15"] = WITH(ZS) + f"""SELECT ym, cc_id, cc_name, nature, amount, mean, var_pc, z
FROM zs WHERE _mean IS NOT NULL AND ABS(_z) > {D(K.Z_SIGNIFICANT)}
ORDER BY ym DESC, ABS(z) DESC, cc_id, nature LIMIT 15"""

SQL["control_by_year"] = WITH(SALES) + f"""SELECT yr, {DR(MIL(MS('revenue')), 2)} AS revenue_m,
  {DR(MIL(MS('margin')), 2)} AS margin_m, {PCT(MS('margin'), MS('revenue'))} AS margin_pc
FROM sales GROUP BY yr ORDER BY yr"""


def _mix(axis: str) -> str:
    return WITH(SALES) + f"""SELECT {axis}, {DR(MIL(MS('revenue')), 2)} AS revenue_m,
  {PCT(MS('revenue'), f"(SELECT {MS('revenue')} FROM sales WHERE yr = {Y})")} AS share_pc
FROM sales WHERE yr = {Y} GROUP BY {axis} ORDER BY revenue_m DESC, {axis}"""


SQL["control_channel_mix"] = _mix("ch")
SQL["control_category_mix"] = _mix("cat")

SQL["control_growth"] = WITH(SALES) + f""", y AS (SELECT yr, {MS('revenue')} AS revenue FROM sales GROUP BY yr)
SELECT yr, {DR(MIL('revenue'), 2)} AS revenue_m,
  {PCT('revenue - LAG(revenue) OVER (ORDER BY yr)', 'LAG(revenue) OVER (ORDER BY yr)')} AS growth_pc
FROM y ORDER BY yr"""

SQL["calendar_dim"] = f"""WITH b AS (
  SELECT MIN(CAST(o_orderdate AS DATE)) AS s, MAX(CAST(o_orderdate AS DATE)) AS e FROM orders),
d AS (SELECT CAST(unnest(generate_series(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id,
  CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS mo,
  CAST(year(date) AS INTEGER) AS yr, CAST(quarter(date) AS INTEGER) AS qtr,
  CAST(weekofyear(date) AS INTEGER) AS week, dayname(date) AS weekday_name,
  isodow(date) IN (6, 7) AS is_weekend, strftime(date, '%Y-%m') AS ym,
  month(date) IN {IN(K.SALE_MONTHS)} AS is_sale,
  (month(date) = 11 AND day(date) >= {K.BLACK_FRIDAY_FROM_DAY}) AS is_black_friday,
  (month(date) = 12 AND day(date) BETWEEN 1 AND {K.CHRISTMAS_LAST_DAY}) AS is_christmas
FROM d"""

SQL["seasonal_allocation"] = WITH(SALES, COEF) + f""", y AS (SELECT yr, {MS('revenue')} AS revenue FROM sales GROUP BY yr),
t AS (SELECT yr, CAST(LAG(revenue) OVER (ORDER BY yr) AS DOUBLE) * {D(1.0 + K.GROWTH_N)} AS target,
             LAG(yr) OVER (ORDER BY yr) AS py FROM y),
m AS (SELECT t.yr, c.mo, t.target, c.coef FROM t CROSS JOIN coef c WHERE t.py = t.yr - 1)
SELECT yr, mo, {R('target * coef / SUM(coef) OVER (PARTITION BY yr)', 2)} AS target FROM m"""

SQL["running_cutoff"] = WITH(SALES) + f""", r AS (
  SELECT ym, CAST(revenue AS DECIMAL(18,4)) AS revenue,
    COALESCE(SUM(CAST(revenue AS DECIMAL(18,4))) OVER (PARTITION BY ym ORDER BY l_orderkey, l_linenumber, l_partkey,
             l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    SUM(CAST(revenue AS DECIMAL(18,4))) OVER (PARTITION BY ym) * CAST({PARAMS['cutoff_share']!r} AS DECIMAL(10,4)) AS target
  FROM sales)
SELECT ym, COUNT(*) FILTER (WHERE before < target) AS kept_rows,
  {DR('SUM(revenue) FILTER (WHERE before < target)', 2)} AS kept_revenue,
  {DR('MAX(target)', 2)} AS target
FROM r GROUP BY ym"""

_up = S(PARAMS["upmarket_cat"])
_md_cat, _md_coll = PARAMS["markdown"]
SQL["price_scenario"] = WITH(SALES) + f""", p AS (
  SELECT cat, ym, revenue,
    NOT (yr = {Y} AND cat = {_up} AND l_linenumber = 3) AS kept,
    CASE WHEN yr = {Y} AND cat = {_up} THEN {K.PRICE_UPMARKET} ELSE 1.00 END
    * CASE WHEN yr = {Y} AND mo = {K.MARKDOWN_MONTH} AND cat = {S(_md_cat)} AND collection = {S(_md_coll)} THEN {K.PRICE_MARKDOWN} ELSE 1.00 END
    * CASE WHEN mo IN {IN(K.SALE_MONTHS)} AND l_linenumber <= 2 THEN {K.PRICE_SALE} ELSE 1.00 END AS mult
  FROM sales)
SELECT cat, ym, {DR(MS('revenue'), 2)} AS revenue_before,
  {DR('SUM(CASE WHEN kept THEN CAST(revenue AS DECIMAL(18,4)) * mult END)', 2)} AS revenue_after,
  COUNT(CASE WHEN kept THEN 1 END) AS lines_after
FROM p GROUP BY cat, ym"""

SQL["line_valuation"] = f"""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
  {R('l.l_extendedprice * (1 - l.l_discount) / NULLIF(l.l_quantity, 0) * l.l_quantity', 2)} AS revenue,
  {R('p.p_retailprice * l.l_quantity', 2)} AS cost
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey"""

SQL["sku_monthly_demand"] = WITH(SALES) + f"""SELECT ym, sku, SUM(qty) AS qty, {DR(MS('cost'), 2)} AS cost
FROM sales GROUP BY ym, sku"""

_os_cat, _os_coll = PARAMS["overstock"]
PURCH = SALES + f""",
demand AS (SELECT ym, sku, SUM(qty) AS qty FROM sales GROUP BY ym, sku),
pj AS (
  SELECT d.ym, d.sku, CAST(substr(d.ym, 1, 4) AS INTEGER) AS yr, CAST(substr(d.ym, 6, 2) AS INTEGER) AS mo,
         d.qty, p.p_type AS cat, p.p_brand AS collection, p.p_retailprice AS unit_cost
  FROM demand d JOIN part p ON d.sku = p.p_partkey),
pq AS (
  SELECT ym, sku, unit_cost,
    CAST(FLOOR(qty * CASE WHEN yr = {Y} AND mo IN {IN(K.OVERSTOCK_MONTHS)} AND cat = {S(_os_cat)} AND collection = {S(_os_coll)}
                          THEN {D(K.OVERSTOCK_FACTOR)} ELSE {D(1.0)} END) AS BIGINT) AS qty,
    CASE WHEN yr = {Y} AND mo >= {K.FREIGHT_STEP_MONTH} THEN {D(K.FREIGHT_RATE_FROM_STEP)} ELSE {D(K.FREIGHT_RATE)} END AS rate
  FROM pj),
pg AS (SELECT ym, sku, qty, rate, {R('qty * unit_cost', 2)} AS goods FROM pq),
purchases AS (SELECT ym, sku, qty, goods, {R('goods * rate', 2)} AS freight FROM pg)"""

SQL["purchase_costing"] = WITH(PURCH) + "SELECT ym, sku, qty, goods, freight, goods + freight AS total FROM purchases"

SQL["budget_revenue"] = WITH(BUDGET) + "SELECT yr, mo, type, ch, cat, amount, margin_pc FROM brev"
SQL["budget_expense"] = WITH(BUDGET) + "SELECT yr, mo, type, cc_id, amount FROM bexp"
SQL["budget_union"] = WITH(BUDGET) + "SELECT * FROM budget"

_sp_cc, _sp_nat = PARAMS["charge_spike"]
SCHED_MONTHS = f"""sm AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{Y1}-01-01', TIMESTAMP '{Y}-12-01', INTERVAL 1 MONTH)) AS DATE) AS month)"""
SQL["charge_schedule"] = WITH(CHM, SCHED_MONTHS) + f""", b AS (
  SELECT cc_id, nature, CAST(SUM(amount) AS DOUBLE) / {D(12.0)} AS base FROM chm WHERE ym LIKE '{Y1}%' GROUP BY cc_id, nature)
SELECT strftime(sm.month, '%Y-%m') AS ym, b.cc_id, b.nature,
  {R(f"b.base * CASE WHEN b.cc_id = {S(_sp_cc)} AND b.nature = {S(_sp_nat)} AND year(sm.month) = {Y} AND month(sm.month) IN {IN(K.CHARGE_SPIKE_MONTHS)} THEN {D(K.CHARGE_SPIKE)} ELSE {D(1.0)} END * CASE WHEN b.cc_id IN {IN(PARAMS['marketing_cc'])} AND month(sm.month) IN {IN(K.MARKETING_PEAK_MONTHS)} THEN {D(K.MARKETING_PEAK)} ELSE {D(1.0)} END", 2)} AS amount
FROM b CROSS JOIN sm"""

PAYROLL = CC + ",\n" + SCHED_MONTHS + f""",
payroll AS (
  SELECT strftime(sm.month, '%Y-%m') AS ym, cc.cc_id,
    {R(f"cc.payroll_base * CASE WHEN year(sm.month) = {Y} THEN {D(K.PAYROLL_RAISE_N)} ELSE {D(1.0)} END * CASE WHEN month(sm.month) = 12 THEN {D(K.PAYROLL_DECEMBER)} ELSE {D(1.0)} END", 2)} AS amount
  FROM cc CROSS JOIN sm)"""
SQL["payroll_schedule"] = WITH(PAYROLL) + "SELECT ym, cc_id, amount FROM payroll"

SQL["surrogate_keys"] = """SELECT o_orderkey, printf('CMD%08d', ROW_NUMBER() OVER (ORDER BY o_orderkey)) AS order_code
FROM orders"""

SQL["surrogate_keys_lines"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  printf('VTE%010d', ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS line_code
FROM lineitem"""

SQL["surrogate_keys_customers"] = """SELECT c_custkey, printf('C%06d', ROW_NUMBER() OVER (ORDER BY c_custkey)) AS customer_code
FROM customer"""

SQL["surrogate_keys_products"] = """SELECT p_partkey, printf('SKU%06d', ROW_NUMBER() OVER (ORDER BY p_partkey)) AS product_code
FROM part"""

SQL["surrogate_keys_invoices"] = WITH(PURCH) + """
SELECT ym, sku, printf('FA%07d', ROW_NUMBER() OVER (ORDER BY ym, sku)) AS invoice_code FROM purchases"""

SQL["freight_ratio_trend"] = WITH(PURCH) + f""", m AS (
  SELECT ym, {MS('goods')} AS goods, {MS('freight')} AS freight,
         {DIV(MS('freight'), MS('goods'))} * {D(100.0)} AS r
  FROM purchases GROUP BY ym)
SELECT ym, {DR('goods', 2)} AS goods, {DR('freight', 2)} AS freight, {R('r', 3)} AS ratio_pc,
  {R('r - LAG(r) OVER (ORDER BY ym)', 3)} AS change_pts FROM m ORDER BY ym"""

SQL["margin_drift"] = WITH(CUBE) + f""", m AS (
  SELECT ym, cat, {DIV('SUM(margin)', 'SUM(revenue)')} * {D(100.0)} AS pc
  FROM cube WHERE cat IS NOT NULL GROUP BY ym, cat),
t AS (SELECT *, AVG(pc) OVER (PARTITION BY cat ORDER BY ym ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS tm FROM m)
SELECT ym, cat, {R('pc', 2)} AS margin_pc, {R('tm', 2)} AS trailing_mean, {R('pc - tm', 2)} AS gap FROM t"""

SQL["working_capital_impact"] = WITH(DSO) + f"""SELECT ym, ch, dso_days, mom,
  {R('mom * amount / ' + D(30.0), 2)} AS impact FROM dsow"""

SQL["pnl_operating"] = WITH(CUBE, CHM, PAYROLL) + f""", m AS (SELECT ym, SUM(margin) AS margin FROM cube GROUP BY ym),
c AS (SELECT ym, SUM(amount) AS charges FROM chm GROUP BY ym),
p AS (SELECT ym, {MS('amount')} AS payroll FROM payroll GROUP BY ym),
j AS (SELECT COALESCE(m.ym, c.ym, p.ym) AS ym, m.margin, c.charges, p.payroll
      FROM m FULL OUTER JOIN c ON m.ym = c.ym FULL OUTER JOIN p ON COALESCE(m.ym, c.ym) = p.ym)
SELECT ym, {DR('margin', 2)} AS margin, {DR('charges', 2)} AS charges, {DR('payroll', 2)} AS payroll,
  {DR('COALESCE(margin, 0) - COALESCE(charges, 0) - COALESCE(payroll, 0)', 2)} AS operating_result
FROM j ORDER BY ym"""

SQL["revenue_zscores"] = WITH(CUBE) + f""", z AS (
  SELECT ym, ch, cat, revenue,
    AVG(CAST(revenue AS DOUBLE)) OVER (PARTITION BY ch, cat ORDER BY ym ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS mean12,
    STDDEV_SAMP(CAST(revenue AS DOUBLE)) OVER (PARTITION BY ch, cat ORDER BY ym ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS std12
  FROM cube),
z2 AS (SELECT *, {DIV('revenue - mean12', 'std12')} AS zz FROM z)
SELECT ym, ch, cat, {DR('revenue', 0)} AS revenue, {R('mean12', 0)} AS mean, {R('zz', 2)} AS z,
  CASE WHEN ABS(zz) > {D(K.Z_MAJOR)} THEN {S(K.SEVERITY_LABELS['major'])}
       WHEN ABS(zz) > {D(K.Z_SIGNIFICANT)} THEN {S(K.SEVERITY_LABELS['significant'])}
       ELSE {S(K.SEVERITY_LABELS['normal'])} END AS severity
FROM z2"""

_BACK = "PARTITION BY {keys} ORDER BY year(m) * 12 + month(m) RANGE BETWEEN {first} PRECEDING AND {last}"


def _back(keys: str, first: int, last: int) -> str:
    return _BACK.format(keys=keys, first=first, last=f"{last} PRECEDING" if last else "CURRENT ROW")


def _dense(name: str, source: str, keys: list[str], value: str, fill: str) -> str:
    """Every month of a series between its first and its last, by a series table and a join."""
    same = " AND ".join(f"d.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    return f"""{name} AS (
  SELECT {', '.join('s.' + k for k in keys)}, s.m, strftime(s.m, '%Y-%m') AS ym, d.ym IS NULL AS filled, {fill.format('d.' + value)} AS {value}
  FROM (SELECT {', '.join(keys)}, CAST(unnest(generate_series(MIN(CAST(ym || '-01' AS TIMESTAMP)), MAX(CAST(ym || '-01' AS TIMESTAMP)),
          INTERVAL 1 MONTH)) AS DATE) AS m FROM {source} WHERE ym IS NOT NULL GROUP BY {', '.join(keys)}) s
  LEFT JOIN {source} d ON {same} AND d.ym = strftime(s.m, '%Y-%m'))"""


SQL["dso_yoy_dense"] = WITH(DSO, _dense("dd", "dso", ["ch"], "dso_days", "{}")) + f"""SELECT ym, ch, filled, dso_days,
  {R(f"AVG(dso_days) OVER ({_back('ch', 2, 0)})", 1)} AS dso_avg3,
  dso_days - MAX(dso_days) OVER ({_back('ch', 1, 1)}) AS mom,
  {R(f"dso_days - MAX(dso_days) OVER ({_back('ch', 12, 12)})", 1)} AS yoy
FROM dd ORDER BY ch NULLS LAST, ym"""

SQL["charges_baseline_dense"] = WITH(CHM, _dense("cd", "chm", ["cc_id", "nature"], "amount", "COALESCE({}, 0)")) + f"""
SELECT ym, cc_id, nature, filled, {DR('amount', 2)} AS amount,
  {R(f"AVG(CAST(amount AS DOUBLE)) OVER ({_back('cc_id, nature', 12, 1)})", 2)} AS mean12,
  {R(f"STDDEV_SAMP(CAST(amount AS DOUBLE)) OVER ({_back('cc_id, nature', 12, 1)})", 2)} AS std12 FROM cd"""

SQL["headline_kpis_reduced"] = SQL["headline_kpis"]
SQL["category_split_reduced"] = SQL["category_split"]

_NONE = "CAST(NULL AS DOUBLE)"


def _share(grain: str, axis: str) -> str:
    return f"""SELECT '{grain}', {axis}, {DR(MIL(MS('revenue')), 2)}, {_NONE}, {_NONE}, {_NONE},
  {PCT(MS('revenue'), f"(SELECT {MS('revenue')} FROM sales WHERE yr = {Y})")} FROM sales WHERE yr = {Y} GROUP BY {axis}"""


SQL["control_pack"] = WITH(SALES) + f""", y AS (SELECT yr, {MS('revenue')} AS revenue, {MS('margin')} AS margin FROM sales GROUP BY yr)
SELECT 'year' AS grain, CAST(yr AS VARCHAR) AS key, {DR(MIL('revenue'), 2)} AS revenue_m, {DR(MIL('margin'), 2)} AS margin_m,
  {PCT('margin', 'revenue')} AS margin_pc, {PCT('revenue - LAG(revenue) OVER (ORDER BY yr)', 'LAG(revenue) OVER (ORDER BY yr)')} AS growth_pc,
  {_NONE} AS share_pc FROM y
UNION ALL {_share('channel', 'ch')} UNION ALL {_share('category', 'cat')}"""

SQL["pnl_monthly_cube_refreshed"] = SQL["pnl_monthly_cube"]

SQL["surrogate_keys_reloaded"] = f"""SELECT o_orderkey, printf('CMD%08d', ROW_NUMBER() OVER (
  ORDER BY CASE WHEN CAST(o_orderdate AS DATE) < DATE '{Y}-01-01' THEN 0 ELSE 1 END, o_orderkey)) AS order_code FROM orders"""


def _apportioned(name: str, source: str, by: str, keys: str) -> str:
    """Largest remainders of ``source`` (by, keys, target, weight) in whole cents."""
    cells = ", ".join(x for x in (by, keys) if x)
    group = f"PARTITION BY {by}" if by else ""
    return f"""{name}_s AS (SELECT *, CAST(SUM(weight) OVER ({group}) AS HUGEINT) AS whole FROM ({source}) WHERE weight > 0),
{name}_r AS (SELECT *, target * weight // whole AS base, target * weight % whole AS rest FROM {name}_s),
{name} AS (
  SELECT {cells}, base + CASE WHEN ROW_NUMBER() OVER ({group} ORDER BY rest DESC, {keys}) <= target - SUM(base) OVER ({group})
    THEN 1 ELSE 0 END AS cents FROM {name}_r)"""


SQL["budget_revenue_sku"] = WITH(SALES, COEF) + f""", sold AS (
  SELECT ch, sku, {MS('revenue')} AS revenue FROM sales WHERE yr = {Y1} GROUP BY ch, sku),
t AS (SELECT CAST(ROUND(SUM(revenue) * CAST({round(1.0 + K.GROWTH_N, 6)!r} AS DECIMAL(10,6)), 2) * 100 AS HUGEINT) AS target FROM sold),
products AS (SELECT ch, sku % 64 AS bucket, sku, CAST(revenue * 10000 AS HUGEINT) AS weight FROM sold WHERE ch IS NOT NULL AND sku IS NOT NULL),
{_apportioned("l1", "SELECT mo, target, CAST(ROUND(coef * 100) AS HUGEINT) AS weight FROM coef, t", "", "mo")},
{_apportioned("l2", "SELECT mo, ch, CAST(cents AS HUGEINT) AS target, weight FROM l1, (SELECT ch, CAST(SUM(weight) AS HUGEINT) AS weight FROM products GROUP BY ch)", "mo", "ch")},
{_apportioned("l3", "SELECT mo, ch, bucket, CAST(cents AS HUGEINT) AS target, weight FROM l2 JOIN (SELECT ch, bucket, CAST(SUM(weight) AS HUGEINT) AS weight FROM products GROUP BY ch, bucket) USING (ch)", "mo, ch", "bucket")},
{_apportioned("l4", "SELECT mo, ch, bucket, sku, CAST(cents AS HUGEINT) AS target, weight FROM l3 JOIN products USING (ch, bucket)", "mo, ch, bucket", "sku")}
SELECT {Y} AS yr, CAST(mo AS INTEGER) AS mo, ch, sku, CAST(cents AS DOUBLE) / 100 AS amount FROM l4"""

SQL["typed_load_outcome"] = """SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 101 = 0 AND o_orderkey % 103 = 0 THEN 'type: order_date, total'
       WHEN o_orderkey % 101 = 0 THEN 'type: order_date'
       WHEN o_orderkey % 103 = 0 THEN 'type: total'
       WHEN o_orderkey % 109 = 0 THEN 'missing: status' END AS reason
FROM orders"""
SQL["filter_years_in_use"] = WITH(SALES) + "SELECT DISTINCT yr FROM sales WHERE yr IS NOT NULL ORDER BY yr DESC"
SQL["filter_channels_in_use"] = WITH(SALES) + "SELECT DISTINCT ch FROM sales WHERE ch IS NOT NULL ORDER BY ch"
SQL["pnl_channel_slice_clustered"] = SQL["pnl_channel_slice"]
