"""The registered queries as plain SQL over the source tables, for DuckDB.

Written in the textbook form of each query (windows, self-joins, DISTINCT counts), not in
the form the Spark plans take. Rounded ratios use integer arithmetic: DuckDB averages
decimals as doubles, which rounds some halves the other way.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"


def cents(expr: str) -> str:
    return f"CAST({expr} * 100 AS HUGEINT)"


def rounded(numerator: str, denominator: str, scale: int = 2) -> str:
    """``numerator / denominator``, whole numbers counted in units of 10^-scale, half up."""
    unit = {0: "1", 2: "CAST(0.01 AS DECIMAL(3,2))", 4: "CAST(0.0001 AS DECIMAL(5,4))",
            6: "CAST(0.000001 AS DECIMAL(7,6))"}[scale]
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return (f"CAST(CAST((2*({n}) + ({d})) // NULLIF(2*({d}), 0) AS DECIMAL(18,0)) * {unit} "
            f"AS DECIMAL(18,{scale}))")


def mean(expr: str) -> str:
    """Mean of a two-place amount."""
    return rounded(f"SUM({cents(expr)})", f"COUNT({expr})")


def pct(part: str, whole: str) -> str:
    return rounded(f"10000 * ({part})", whole)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


VALID = "status IN ('paid', 'shipped', 'received')"

_PRELUDE = f"""
ods_users AS (
  SELECT printf('U%08d', c_custkey + 1) AS user_id, c_name AS username,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST(16 + c_custkey % 52 AS INTEGER) AS age, n_name AS city,
         printf('1%010d', c_custkey) AS phone,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Bronze' WHEN 'BUILDING' THEN 'Silver'
              WHEN 'FURNITURE' THEN 'Gold' WHEN 'HOUSEHOLD' THEN 'Platinum' ELSE 'Diamond' END AS level,
         CAST(DATE '1995-01-01' - CAST(c_custkey % 730 AS INTEGER) AS DATE) AS register_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
ods_products AS (
  SELECT printf('P%06d', p_partkey + 1) AS product_id, p_name AS product_name, p_type AS category,
         concat(p_type, '-', CAST(p_size % 5 AS VARCHAR)) AS sub_category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS brand,
         CAST(p_size * 100 AS INTEGER) AS stock,
         CAST(DATE '1995-01-01' - CAST(p_partkey % 730 AS INTEGER) AS DATE) AS on_shelf_date
  FROM part),
ods_order_items AS (
  SELECT printf('O%09d', l_orderkey + 1) AS order_id, printf('P%06d', l_partkey + 1) AS product_id,
         CAST(SUM(l_quantity) AS INTEGER) AS quantity,
         CAST(MAX(p_retailprice) AS DECIMAL(10,2)) AS unit_price,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS amount
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, l_partkey),
ods_orders AS (
  SELECT order_id, user_id, total_amount, status, item_count, create_time,
         CASE WHEN status <> 'cancelled' THEN create_time + to_minutes(1 + o_orderkey % 30) END AS pay_time
  FROM (SELECT o_orderkey, printf('O%09d', o_orderkey + 1) AS order_id,
               printf('U%08d', o_custkey + 1) AS user_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'cancelled'
                    WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 'refunded'
                    WHEN o_orderstatus = 'P' THEN 'paid' WHEN o_orderstatus = 'O' THEN 'shipped'
                    ELSE 'received' END AS status,
               CAST(coalesce(n, 0) AS INTEGER) AS item_count,
               o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS create_time
        FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(DISTINCT l_partkey) AS n FROM lineitem
                               GROUP BY l_orderkey) ON l_orderkey = o_orderkey)),
dwd_orders AS (
  SELECT o.order_id, o.user_id, u.username, u.age, u.city, u.level AS user_level, o.total_amount,
         o.item_count, o.status, o.create_time, o.pay_time, CAST(o.create_time AS DATE) AS order_date,
         CAST(hour(o.create_time) AS INTEGER) AS order_hour,
         CAST(isodow(o.create_time) AS INTEGER) AS order_weekday,
         CASE WHEN o.{VALID} THEN 1 ELSE 0 END AS is_valid_order,
         CASE WHEN ROW_NUMBER() OVER (PARTITION BY o.user_id ORDER BY o.create_time, o.order_id) = 1
              THEN 1 ELSE 0 END AS is_first_order,
         CAST(date_sub('minute', o.create_time, o.pay_time) AS INTEGER) AS pay_latency_min
  FROM ods_orders o LEFT JOIN ods_users u ON o.user_id = u.user_id),
dwd_order_items AS (
  SELECT oi.order_id, oi.product_id, oi.quantity, oi.unit_price, oi.amount, p.product_name, p.category,
         p.sub_category, p.brand, o.user_id, o.create_time AS order_time,
         CASE WHEN o.{VALID} THEN 1 ELSE 0 END AS is_valid_order
  FROM ods_order_items oi JOIN ods_orders o ON oi.order_id = o.order_id
       LEFT JOIN ods_products p ON oi.product_id = p.product_id),
valid_orders AS (SELECT * FROM dwd_orders WHERE is_valid_order = 1),
valid_items AS (SELECT * FROM dwd_order_items WHERE is_valid_order = 1)"""


def _user_layers(grain: str) -> str:
    """Per-user measures and RFM, by whole orders or by a join of orders to their items."""
    if grain == "order":
        rows = """
  SELECT u.user_id, u.username, u.city, u.level, o.order_id, o.order_date, o.is_valid_order,
         o.total_amount, q.quantity
  FROM ods_users u LEFT JOIN dwd_orders o ON o.user_id = u.user_id
       LEFT JOIN (SELECT order_id, SUM(quantity) AS quantity FROM valid_items GROUP BY order_id) q
              ON q.order_id = o.order_id"""
    else:
        rows = """
  SELECT u.user_id, u.username, u.city, u.level, o.order_id, o.order_date, o.is_valid_order,
         o.total_amount, oi.quantity
  FROM ods_users u LEFT JOIN dwd_orders o ON o.user_id = u.user_id
       LEFT JOIN dwd_order_items oi ON oi.order_id = o.order_id AND o.is_valid_order = 1"""
    days = "COUNT(DISTINCT order_date)"
    gap = rounded("100 * date_diff('day', MIN(order_date), MAX(order_date))", f"({days} - 1)")
    valid_amount = "CASE WHEN is_valid_order = 1 THEN total_amount END"
    segment = """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'A_Important_Value'
              WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'B_Important_Develop'
              WHEN r_score >= 4 AND f_score <= 2 AND m_score >= 4 THEN 'C_Important_Keep'
              WHEN r_score <= 2 AND f_score <= 2 AND m_score >= 4 THEN 'D_Important_Recover'
              WHEN r_score >= 4 AND f_score >= 4 AND m_score <= 2 THEN 'E_General_Value'
              WHEN r_score <= 2 AND f_score >= 4 AND m_score <= 2 THEN 'F_General_Develop'
              WHEN r_score >= 4 AND f_score <= 2 AND m_score <= 2 THEN 'G_General_Keep'
              ELSE 'H_Churned' END"""
    return f""",
user_rows AS ({rows}),
user_base AS (
  SELECT user_id, username, city, level AS user_level,
         {big('COUNT(DISTINCT order_id)')} AS total_orders,
         {big('SUM(CASE WHEN is_valid_order = 1 THEN 1 ELSE 0 END)')} AS valid_orders,
         {big('COALESCE(SUM(quantity), 0)')} AS total_quantity,
         {money('SUM(CASE WHEN is_valid_order = 1 THEN total_amount ELSE 0 END)')} AS total_amount,
         MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
         CAST(date_diff('day', MAX(order_date), {AS_OF}) AS INTEGER) AS days_since_last,
         {big(days)} AS active_days,
         {mean(valid_amount)} AS avg_order_amount,
         CAST(CASE WHEN {days} > 1 THEN {gap} ELSE 0 END AS DECIMAL(10,2)) AS avg_days_between,
         CASE WHEN COUNT(DISTINCT order_id) >= 2 THEN 1 ELSE 0 END AS is_repurchase
  FROM user_rows GROUP BY user_id, username, city, level),
scores AS (
  SELECT user_id, CAST(NTILE(5) OVER (ORDER BY days_since_last DESC, user_id) AS INTEGER) AS r_score,
         CAST(NTILE(5) OVER (ORDER BY valid_orders, user_id) AS INTEGER) AS f_score,
         CAST(NTILE(5) OVER (ORDER BY total_amount, user_id) AS INTEGER) AS m_score
  FROM user_base WHERE valid_orders > 0),
favorites AS (
  SELECT user_id, category, spend,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY spend DESC NULLS LAST, category NULLS FIRST) AS rn
  FROM (SELECT user_id, category, SUM(amount) AS spend FROM valid_items GROUP BY user_id, category)),
dws_user_summary AS (
  SELECT b.user_id, b.username, b.city, b.user_level, b.total_orders, b.valid_orders, b.total_quantity,
         b.total_amount, b.first_order_date, b.last_order_date, b.days_since_last, b.active_days,
         b.avg_order_amount, b.avg_days_between, s.r_score, s.f_score, s.m_score,
         CAST(s.r_score AS VARCHAR) || CAST(s.f_score AS VARCHAR) || CAST(s.m_score AS VARCHAR) AS rfm_score,
         {segment} AS rfm_segment, f.category AS favorite_category,
         {money('f.spend')} AS favorite_category_amount, b.is_repurchase
  FROM user_base b LEFT JOIN scores s ON s.user_id = b.user_id
       LEFT JOIN favorites f ON f.user_id = b.user_id AND f.rn = 1)"""


_PRODUCT_AND_DATE = f""",
product_base AS (
  SELECT product_id, any_value(product_name) AS product_name, any_value(category) AS category,
         any_value(sub_category) AS sub_category, any_value(brand) AS brand,
         MAX(unit_price) AS price, {big('SUM(quantity)')} AS total_quantity,
         {big('COUNT(DISTINCT order_id)')} AS total_orders, {big('COUNT(DISTINCT user_id)')} AS total_users,
         {money('SUM(amount)')} AS total_amount,
         MIN(CAST(order_time AS DATE)) AS first_sale_date, MAX(CAST(order_time AS DATE)) AS last_sale_date,
         CAST({rounded('100 * SUM(quantity)', 'COUNT(quantity)')} AS DECIMAL(10,2)) AS avg_quantity_per_order,
         {rounded('100 * SUM(quantity)', 'COUNT(DISTINCT user_id)')} AS avg_user_quantity
  FROM valid_items GROUP BY product_id),
dws_product_summary AS (
  SELECT *, RANK() OVER (PARTITION BY category ORDER BY total_quantity DESC) AS category_rank
  FROM product_base),
dws_date_summary AS (
  SELECT order_date AS date,
         {big('COUNT(DISTINCT CASE WHEN is_valid_order = 1 THEN o.user_id END)')} AS dau,
         {big('COUNT(DISTINCT CASE WHEN is_first_order = 1 AND is_valid_order = 1 THEN o.user_id END)')} AS new_users,
         {big('COUNT(DISTINCT CASE WHEN is_valid_order = 1 AND s.is_repurchase = 1 THEN o.user_id END)')}
           AS repurchase_users,
         {big('COUNT(DISTINCT o.user_id)')} AS total_active_users,
         {big('COUNT(DISTINCT order_id)')} AS total_orders,
         {big('SUM(is_valid_order)')} AS valid_orders,
         {money('SUM(CASE WHEN is_valid_order = 1 THEN o.total_amount ELSE 0 END)')} AS total_amount,
         {mean('CASE WHEN is_valid_order = 1 THEN o.total_amount END')} AS avg_order_value,
         {rounded(f"SUM({cents('CASE WHEN is_valid_order = 1 THEN o.total_amount ELSE 0 END')})",
                  'COUNT(DISTINCT CASE WHEN is_valid_order = 1 THEN o.user_id END)')} AS avg_user_amount,
         CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
         CAST(isodow(order_date) AS INTEGER) AS weekday
  FROM dwd_orders o LEFT JOIN dws_user_summary s ON o.user_id = s.user_id
  GROUP BY order_date)"""


def dwd(select: str) -> str:
    return f"WITH {_PRELUDE}\n{select}"


def dws(select: str, grain: str = "order") -> str:
    return f"WITH {_PRELUDE}{_user_layers(grain)}{_PRODUCT_AND_DATE}\n{select}"


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH {_PRELUDE},\n{ctes}\n{select}"


def _retention(source: str, user: str, day: str, horizons: dict[str, tuple[int, int]], amounts: bool = True) -> str:
    columns = []
    for name, (low, high) in horizons.items():
        kept = (f"COUNT(DISTINCT CASE WHEN date_diff('day', f.first_date, a.day) BETWEEN {low} AND {high} "
                f"THEN f.usr END)")
        if amounts:
            columns.append(f"{big(kept)} AS {name}_retained")
        columns.append(f"{pct(kept, 'COUNT(DISTINCT f.usr)')} AS {name}_retention_pct")
    return f"""
SELECT f.first_date, COUNT(DISTINCT f.usr) AS new_users, {', '.join(columns)}
FROM (SELECT {user} AS usr, MIN({day}) AS first_date FROM {source} GROUP BY {user}) f
LEFT JOIN (SELECT DISTINCT {user} AS usr, {day} AS day FROM {source}) a ON a.usr = f.usr
GROUP BY f.first_date"""


def _streaks(source: str, user: str, day: str, min_days: int, users: bool = False) -> str:
    extra = ", COUNT(DISTINCT usr) AS distinct_users" if users else ""
    return f"""
SELECT consecutive_days, COUNT(*) AS run_count{extra}
FROM (SELECT usr, grp, COUNT(*) AS consecutive_days
      FROM (SELECT usr, day, day - CAST(ROW_NUMBER() OVER (PARTITION BY usr ORDER BY day) AS INTEGER) AS grp
            FROM (SELECT DISTINCT {user} AS usr, {day} AS day FROM {source}))
      GROUP BY usr, grp)
WHERE consecutive_days >= {min_days} GROUP BY consecutive_days"""


_HORIZONS = {"d1": (1, 1), "d7": (1, 7), "d30": (1, 30)}
_GAPS = """gaps AS (
  SELECT date_diff('day', CAST(prev_time AS DATE), CAST(create_time AS DATE)) AS days
  FROM (SELECT create_time, LAG(create_time) OVER (PARTITION BY user_id ORDER BY create_time, order_id) AS prev_time
        FROM valid_orders)
  WHERE prev_time IS NOT NULL)"""


def _bins(bounds: list[tuple[int, str]], rest: str) -> str:
    whens = " ".join(f"WHEN days <= {high} THEN '{label}'" for high, label in bounds)
    return f"CASE {whens} ELSE '{rest}' END"


def _check(check: str, table: str, observed: str, low, high) -> str:
    tests = [f"coalesce(({observed}), 0) >= {low}"] if low is not None else []
    tests += [f"coalesce(({observed}), 0) <= {high}"] if high is not None else []
    passed = " AND ".join(tests) or "true"
    limit = lambda v: f"CAST({'NULL' if v is None else v} AS BIGINT)"
    return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", {big(f'coalesce(({observed}), 0)')} AS observed, "
            f"{limit(low)} AS limit_low, {limit(high)} AS limit_high, "
            f"CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status")


def _checks(*checks: tuple) -> str:
    return "\nUNION ALL ".join(_check(*c) for c in checks)


_STRATEGY = [
    ("A_Important_Value", "VIP 专属服务 + 新品优先体验"), ("B_Important_Develop", "推送新客优惠券,刺激复购"),
    ("C_Important_Keep", "定期唤醒邮件,防流失"), ("D_Important_Recover", "大额优惠券 + 客服主动联系"),
    ("E_General_Value", "保持现状,偶尔推送"), ("F_General_Develop", "新客礼包 + 引导探索"),
    ("G_General_Keep", "标准推送"), ("H_Churned", "不投入营销资源"),
]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Tables
    for name in ("ods_users", "ods_products", "ods_orders", "ods_order_items", "dwd_orders", "dwd_order_items"):
        q[name] = dwd(f"SELECT * FROM {name}")
    base_columns = """user_id, username, city, user_level, total_orders, valid_orders, total_quantity,
  total_amount, first_order_date, last_order_date, days_since_last, active_days, avg_order_amount,
  avg_days_between, is_repurchase"""
    q["dws_user_base"] = dws(f"SELECT {base_columns} FROM user_base")
    q["dws_user_base_item_grain"] = dws(f"SELECT {base_columns} FROM user_base", "item")
    q["dws_user_rfm"] = dws("SELECT user_id, r_score, f_score, m_score, rfm_score, rfm_segment FROM dws_user_summary")
    q["dws_user_favorite"] = dws("SELECT user_id, favorite_category, favorite_category_amount FROM dws_user_summary")
    q["dws_user_summary"] = dws("SELECT * FROM dws_user_summary")
    q["dws_user_summary_item_grain"] = dws("SELECT * FROM dws_user_summary", "item")
    q["dws_product_summary"] = dws("SELECT * FROM dws_product_summary")
    q["dws_date_summary"] = dws("SELECT * FROM dws_date_summary")
    q["dwd_orders_stats"] = dwd(
        f"SELECT COUNT(*) AS total, {big('SUM(is_valid_order)')} AS valid, {big('SUM(is_first_order)')} AS first "
        "FROM dwd_orders")
    q["dwd_items_stats"] = dwd(
        f"SELECT COUNT(*) AS total, {big('SUM(is_valid_order)')} AS valid FROM dwd_order_items")
    q["dws_user_stats"] = dws(
        f"SELECT COUNT(*) AS users, {big('SUM(is_repurchase)')} AS repurchase, "
        "COUNT(DISTINCT rfm_segment) AS segments FROM dws_user_summary")
    q["dws_product_stats"] = dws(
        f"SELECT COUNT(*) AS products, {money('SUM(total_amount)')} AS gmv FROM dws_product_summary")
    q["dws_date_stats"] = dws(
        f"SELECT COUNT(*) AS days, {big('SUM(dau)')} AS total_dau, {money('SUM(total_amount)')} AS gmv "
        "FROM dws_date_summary")

    # Raw table reports
    census = lambda names: " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS rows_count FROM {n}" for n in names)
    q["ods_table_census"] = dwd(census(("ods_users", "ods_products", "ods_orders", "ods_order_items")))
    q["status_share"] = dwd(
        f"SELECT status, COUNT(*) AS cnt, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct "
        "FROM ods_orders GROUP BY status")
    q["valid_order_amounts"] = dwd(
        f"SELECT COUNT(*) AS paid_orders, {money('SUM(total_amount)')} AS gmv, {mean('total_amount')} AS avg_order_value, "
        f"MIN(total_amount) AS min_amt, MAX(total_amount) AS max_amt FROM ods_orders WHERE {VALID}")
    q["city_top10"] = dwd(
        "SELECT city, COUNT(*) AS user_count FROM ods_users GROUP BY city ORDER BY user_count DESC, city LIMIT 10")
    q["category_gmv_ods"] = dwd(
        f"SELECT p.category, COUNT(DISTINCT oi.order_id) AS order_count, {money('SUM(oi.amount)')} AS gmv "
        "FROM ods_order_items oi JOIN ods_products p ON oi.product_id = p.product_id GROUP BY p.category")
    q["order_time_span"] = dwd(
        "SELECT MIN(create_time) AS earliest, MAX(create_time) AS latest, "
        "CAST(date_diff('day', MIN(create_time), MAX(create_time)) AS INTEGER) AS day_span FROM ods_orders")

    # Fact table reports
    q["order_seq"] = dwd(
        "SELECT user_id, order_id, create_time, total_amount, "
        "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY create_time, order_id) AS order_seq FROM valid_orders")
    q["cumulative_spend"] = dwd(
        "SELECT user_id, order_id, create_time, total_amount, "
        f"{money('SUM(total_amount) OVER (PARTITION BY user_id ORDER BY create_time)')} AS cumulative_spent "
        "FROM valid_orders")
    over = "OVER (PARTITION BY user_id ORDER BY create_time, order_id)"
    q["prev_order"] = dwd(
        "SELECT *, CAST(date_diff('day', prev_order_time, create_time) AS INTEGER) AS days_to_prev FROM ("
        f"SELECT user_id, order_id, create_time, total_amount, LAG(create_time) {over} AS prev_order_time, "
        f"LAG(total_amount) {over} AS prev_amount FROM valid_orders)")
    q["first_orders"] = dwd("SELECT * FROM dwd_orders WHERE is_first_order = 1")
    q["user_repurchase_cycle"] = dwd(
        f"SELECT user_id, {rounded('10000 * SUM(days)', 'COUNT(*)', 4)} AS avg_days_to_repurchase, "
        "COUNT(*) AS repurchase_count FROM (SELECT user_id, prev_time, "
        "date_diff('day', CAST(prev_time AS DATE), CAST(create_time AS DATE)) AS days FROM ("
        f"SELECT user_id, create_time, LAG(create_time) {over} AS prev_time FROM valid_orders)) "
        "WHERE prev_time IS NOT NULL GROUP BY user_id")
    q["rfm_levels"] = dwd(
        "SELECT *, CASE WHEN r <= 30 THEN '高' WHEN r <= 90 THEN '中' ELSE '低' END AS r_level, "
        "CASE WHEN f >= 5 THEN '高' WHEN f >= 2 THEN '中' ELSE '低' END AS f_level, "
        "CASE WHEN m >= 5000 THEN '高' WHEN m >= 1000 THEN '中' ELSE '低' END AS m_level FROM ("
        f"SELECT user_id, CAST(date_diff('day', MAX(create_time), {AS_OF}) AS INTEGER) AS r, COUNT(*) AS f, "
        f"{money('SUM(total_amount)')} AS m FROM valid_orders GROUP BY user_id)")
    q["brand_rank"] = dwd(
        "SELECT *, DENSE_RANK() OVER (PARTITION BY category ORDER BY total_sales DESC) AS brand_rank_in_category "
        f"FROM (SELECT category, brand, {money('SUM(amount)')} AS total_sales FROM valid_items "
        "GROUP BY category, brand)")
    month = "strftime(order_date, '%Y-%m')"
    q["monthly_gmv"] = dwd(
        f"SELECT {month} AS month, COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT user_id) AS active_users, "
        f"{money('SUM(total_amount)')} AS gmv, {mean('total_amount')} AS avg_order_value FROM valid_orders GROUP BY 1")
    q["active_30d"] = dwd(
        "SELECT COUNT(*) AS active_user_count FROM (SELECT user_id FROM valid_orders "
        f"WHERE order_date >= {AS_OF} - 30 GROUP BY user_id HAVING COUNT(*) >= 2)")
    q["top_products"] = dwd(
        f"SELECT product_id, product_name, category, brand, {big('SUM(quantity)')} AS total_qty, "
        f"{money('SUM(amount)')} AS total_sales FROM valid_items GROUP BY ALL "
        "ORDER BY total_sales DESC, product_id LIMIT 10")
    q["daily_new_users"] = dwd(
        "SELECT order_date, COUNT(DISTINCT user_id) AS new_user_count FROM valid_orders "
        "WHERE is_first_order = 1 GROUP BY order_date")
    q["retention_d1_d7_d30"] = dwd(_retention("valid_orders", "user_id", "order_date", _HORIZONS))
    q["retention_d7"] = dwd(_retention("valid_orders", "user_id", "order_date", {"d7": (1, 7)}, amounts=False))
    step = lambda cond: f"COUNT(DISTINCT CASE WHEN {cond} THEN user_id END)"
    q["funnel"] = dwd(
        f"SELECT COUNT(DISTINCT user_id) AS step1_total_users, {step(VALID)} AS step2_paid, "
        "{} AS step3_shipped, {} AS step4_received FROM dwd_orders "
        "WHERE is_valid_order = 1 OR status IN ('cancelled', 'refunded')".format(
            step("status IN ('shipped', 'received')"), step("status = 'received'")))
    again = "SUM(CASE WHEN n >= 2 THEN 1 ELSE 0 END)"
    q["repurchase_rate"] = dwd(
        f"SELECT COUNT(*) AS total_buyers, {big(again)} AS repurchase_buyers, "
        f"{pct(again, 'COUNT(*)')} AS repurchase_rate_pct "
        "FROM (SELECT user_id, COUNT(*) AS n FROM valid_orders GROUP BY user_id)")
    bins = _bins([(7, "0-7天"), (30, "8-30天"), (90, "31-90天"), (180, "91-180天")], "180天以上")
    q["repurchase_interval_dist"] = with_ctes(
        _GAPS, f"SELECT {bins} AS interval_range, COUNT(*) AS repurchase_count, "
               f"{pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct FROM gaps GROUP BY 1")
    bins = _bins([(7, "0-7天"), (30, "8-30天"), (90, "31-90天")], "90天以上")
    q["repurchase_interval_dist4"] = with_ctes(
        _GAPS, f"SELECT {bins} AS interval_range, COUNT(*) AS repurchase_count FROM gaps GROUP BY 1")
    q["order_streaks"] = dwd(_streaks("valid_orders", "user_id", "order_date", 2))
    part = lambda flag: money(f"SUM(CASE WHEN is_first_order = {flag} THEN total_amount ELSE 0 END)")
    q["new_vs_returning"] = dwd(
        f"SELECT {month} AS month, {step('is_first_order = 1')} AS new_buyers, "
        f"{step('is_first_order = 0')} AS returning_buyers, {part(1)} AS new_buyer_gmv, "
        f"{part(0)} AS returning_buyer_gmv FROM valid_orders GROUP BY 1")
    q["dwd_table_census"] = dwd(
        f"SELECT 'dwd_orders' AS table_name, COUNT(*) AS total, {big('SUM(is_valid_order)')} AS valid_cnt, "
        f"{big('SUM(is_first_order)')} AS first_order_cnt FROM dwd_orders UNION ALL "
        f"SELECT 'dwd_order_items', COUNT(*), {big('SUM(is_valid_order)')}, NULL FROM dwd_order_items")
    q["valid_vs_invalid"] = dwd(
        f"SELECT is_valid_order, COUNT(*) AS order_count, {money('SUM(total_amount)')} AS total_amount "
        "FROM dwd_orders GROUP BY is_valid_order")
    q["first_order_city"] = dwd(
        f"SELECT city, COUNT(*) AS first_order_user_count, {mean('total_amount')} AS avg_first_order_amount "
        "FROM valid_orders WHERE is_first_order = 1 GROUP BY city ORDER BY 2 DESC, city LIMIT 10")
    q["category_gmv_dwd"] = dwd(
        f"SELECT category, COUNT(DISTINCT order_id) AS order_count, {money('SUM(amount)')} AS gmv "
        "FROM valid_items GROUP BY category")
    q["hourly_orders"] = dwd("SELECT order_hour, COUNT(*) AS order_count FROM valid_orders GROUP BY order_hour")
    q["level_spend"] = dwd(
        f"SELECT user_level, COUNT(DISTINCT user_id) AS user_count, {mean('total_amount')} AS avg_order_amount "
        "FROM valid_orders GROUP BY user_level")
    q["join_vs_denorm"] = q["orders_with_users"] = dwd(
        "SELECT o.order_id, u.username, o.total_amount FROM ods_orders o "
        "LEFT JOIN ods_users u ON o.user_id = u.user_id")

    # Summary table reports
    buyers = "FROM dws_user_summary WHERE valid_orders > 0"
    q["segment_distribution"] = dws(
        f"SELECT rfm_segment, COUNT(*) AS user_count, {mean('total_amount')} AS avg_amount, "
        f"{rounded('100 * SUM(valid_orders)', 'COUNT(*)')} AS avg_orders {buyers} GROUP BY rfm_segment")
    q["vip_users"] = dws(
        "SELECT user_id, username, city, user_level, valid_orders, total_amount, days_since_last, r_score, f_score, "
        "m_score, rfm_score FROM dws_user_summary WHERE rfm_segment = 'A_Important_Value' "
        "ORDER BY total_amount DESC, user_id LIMIT 20")
    q["win_back_users"] = dws(
        "SELECT user_id, username, city, valid_orders, total_amount, days_since_last AS days_inactive, r_score, "
        "f_score, m_score FROM dws_user_summary WHERE rfm_segment IN ('D_Important_Recover', 'H_Churned') "
        "ORDER BY total_amount DESC, user_id LIMIT 30")
    strategy = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in _STRATEGY)
    q["segment_strategy"] = dws(
        f"SELECT rfm_segment, COUNT(*) AS user_count, CASE rfm_segment {strategy} END AS marketing_strategy "
        f"{buyers} GROUP BY rfm_segment")
    q["rfm_score_grid"] = dws(
        f"SELECT r_score, f_score, m_score, COUNT(*) AS user_count {buyers} GROUP BY r_score, f_score, m_score "
        "ORDER BY m_score DESC, f_score DESC, r_score DESC LIMIT 30")
    micro = f"((2 * 10000 * {cents('total_amount')} + valid_orders) // (2 * valid_orders))"
    q["segment_aov"] = dws(
        f"SELECT rfm_segment, {mean('avg_order_amount')} AS avg_aov, "
        f"{rounded(f'SUM({micro})', '10000 * COUNT(*)')} AS calc_aov {buyers} GROUP BY rfm_segment")
    q["dws_table_census"] = dws(census(("dws_user_summary", "dws_product_summary", "dws_date_summary")))
    q["rfm_score_top20"] = dws(
        f"SELECT rfm_score, COUNT(*) AS user_count {buyers} GROUP BY rfm_score ORDER BY rfm_score DESC LIMIT 20")
    q["repurchase_share"] = dws(
        f"SELECT is_repurchase, COUNT(*) AS user_count, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct "
        f"{buyers} GROUP BY is_repurchase")
    q["top_spenders"] = dws(
        f"SELECT user_id, username, city, valid_orders, total_amount, rfm_segment {buyers} "
        "ORDER BY total_amount DESC, user_id LIMIT 10")
    q["top_products_dws"] = dws(
        "SELECT product_id, product_name, category, brand, total_quantity, total_amount, total_users, category_rank "
        "FROM dws_product_summary WHERE total_amount > 0 ORDER BY total_amount DESC, product_id LIMIT 10")
    q["monthly_rollup"] = dws(
        f"SELECT year, month, {big(rounded('SUM(dau)', 'COUNT(dau)', 0))} AS avg_dau, "
        f"{big('SUM(valid_orders)')} AS total_orders, {money('SUM(total_amount)')} AS monthly_gmv "
        "FROM dws_date_summary GROUP BY year, month")
    cohort = _retention("valid_orders", "user_id", "order_date", _HORIZONS)
    q["ads_daily_kpis"] = dws(
        "SELECT d.date, d.dau, d.new_users, d.valid_orders, d.total_amount AS gmv, c.new_users AS cohort_users, "
        f"d1_retention_pct, d7_retention_pct, d30_retention_pct FROM dws_date_summary d LEFT JOIN ({cohort}) c "
        "ON c.first_date = d.date")

    # Profiles
    q["profile_orders"] = dwd(
        f"SELECT COUNT(*) AS orders, {mean('total_amount')} AS avg_amount, MAX(total_amount) AS max_amount, "
        "MIN(total_amount) AS min_amount, MIN(create_time) AS earliest, MAX(create_time) AS latest FROM ods_orders")
    q["value_counts_status"] = dwd("SELECT status, COUNT(*) AS cnt FROM ods_orders GROUP BY status")
    q["value_counts_category"] = dwd("SELECT category, COUNT(*) AS cnt FROM ods_products GROUP BY category")
    q["city_top5"] = dwd(
        "SELECT city, COUNT(*) AS user_count FROM ods_users GROUP BY city ORDER BY user_count DESC, city LIMIT 5")
    four = lambda expr: f"CAST(round({expr}, 4) AS DECIMAL(18,4))"
    price = "CAST(price AS DOUBLE)"
    q["describe_price"] = dwd(
        f"SELECT COUNT(price) AS count, {four(f'CAST(SUM(price) AS DOUBLE) / COUNT(price)')} AS mean, "
        f"{four(f'stddev_samp({price})')} AS std, {four(f'MIN({price})')} AS min, "
        + ", ".join(f"{four(f'quantile_cont({price}, {f})')} AS {n}"
                    for n, f in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
        + f", {four(f'MAX({price})')} AS max FROM ods_products")

    # Quality
    q["dq_row_bands"] = dws(_checks(
        ("row_count", "dws_user_summary", "SELECT COUNT(*) FROM dws_user_summary", 90000, 110000),
        ("row_count", "dws_product_summary", "SELECT COUNT(*) FROM dws_product_summary", 4500, 5500),
        ("row_count", "dws_date_summary", "SELECT COUNT(*) FROM dws_date_summary", 300, 400)))
    count = lambda table, cond: f"SELECT COUNT(*) FROM {table} WHERE {cond}"
    q["dq_orders"] = dwd(_checks(
        ("total", "ods_orders", "SELECT COUNT(*) FROM ods_orders", None, None),
        ("null_user", "ods_orders", count("ods_orders", "user_id IS NULL"), 0, 0),
        ("null_amount", "ods_orders", count("ods_orders", "total_amount IS NULL"), 0, 0),
        ("invalid_amount", "ods_orders", count("ods_orders", "total_amount <= 0"), 0, 0),
        ("suspicious_amount", "ods_orders", count("ods_orders", "total_amount > 100000"), 0, 0)))
    q["dq_first_orders"] = dwd(_check(
        "first_orders_vs_users", "dwd_orders",
        "SELECT abs((SELECT SUM(is_first_order) FROM dwd_orders WHERE user_id IS NOT NULL) - (SELECT COUNT(DISTINCT user_id) FROM dwd_orders))",
        0, 0))
    dup = ("SELECT COUNT(*) FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY l_orderkey, l_partkey "
           "HAVING COUNT(*) > 1)")
    q["dq_pk_items"] = _checks(
        ("duplicate_keys", "lineitem", dup, 0, 0),
        ("null_keys", "lineitem", count("lineitem", "l_orderkey IS NULL OR l_partkey IS NULL"), 0, 0))
    repeated = lambda table, key: f"SELECT COUNT(*) FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)"
    keys = {"ods_users": "user_id", "ods_products": "product_id", "ods_orders": "order_id",
            "ods_order_items": "order_id, product_id", "dwd_orders": "order_id",
            "dwd_order_items": "order_id, product_id", "dws_user_summary": "user_id",
            "dws_product_summary": "product_id", "dws_date_summary": "date"}
    q["dq_primary_keys"] = dws(_checks(*(
        check for table, key in keys.items() for check in (
            ("duplicate_keys", table, repeated(table, key), 0, 0),
            ("null_keys", table, count(table, " OR ".join(f"{c} IS NULL" for c in key.split(", "))), 0, 0)))))
    q["dq_status_domain"] = dwd(_check(
        "unknown_status", "ods_orders",
        count("ods_orders", "status IS NULL OR status NOT IN ('paid','shipped','received','refunded','cancelled')"),
        0, 0))
    lost = lambda child, key, parent: (
        f"SELECT COUNT(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})")
    q["dq_orphans"] = dwd(_checks(
        ("unknown_user_id", "ods_orders", lost("ods_orders", "user_id", "ods_users"), 0, 0),
        ("unknown_order_id", "ods_order_items", lost("ods_order_items", "order_id", "ods_orders"), 0, 0),
        ("unknown_product_id", "ods_order_items", lost("ods_order_items", "product_id", "ods_products"), 0, 0)))
    q["dq_header_vs_items"] = dwd(_check(
        "amount_differs_from_items", "ods_orders",
        "SELECT COUNT(*) FROM ods_orders o LEFT JOIN (SELECT order_id, SUM(amount) AS s FROM ods_order_items "
        "GROUP BY order_id) i ON i.order_id = o.order_id WHERE o.total_amount IS DISTINCT FROM coalesce(i.s, 0)",
        0, 0))
    widths = {"user_id": 20, "username": 100, "gender": 2, "city": 50, "phone": 20, "level": 20}
    q["dq_text_widths"] = dwd(_checks(*(
        (f"longest_{c}", "ods_users", f"SELECT MAX(length({c})) FROM ods_users", None, w) for c, w in widths.items())))

    # Cleaning and incremental loading
    plausible = "user_id IS NOT NULL AND total_amount > 0 AND total_amount <= 100000"
    q["clean_orders"] = dwd(f"SELECT * FROM ods_orders WHERE {plausible}")
    q["quarantined_orders"] = dwd(
        "SELECT *, CASE WHEN user_id IS NULL THEN 'null_user' WHEN total_amount IS NULL THEN 'null_amount' "
        "WHEN total_amount <= 0 THEN 'invalid_amount' ELSE 'suspicious_amount' END AS reason FROM ods_orders "
        f"WHERE ({plausible}) IS NOT TRUE")
    cut = "TIMESTAMP '1999-01-01 00:00:00'"
    number = "CAST(substr(order_id, 2) AS BIGINT)"
    for name in ("incremental_orders", "incremental_orders_by_time"):
        q[name] = dwd(
            f"SELECT CASE WHEN create_time <= {cut} AND {number} % 50 <> 0 THEN 1 ELSE 2 END AS load_number, COUNT(*) AS loaded_rows, "
            f"MIN(create_time) AS earliest, MAX(create_time) AS latest, {money('SUM(total_amount)')} AS amount "
            "FROM ods_orders GROUP BY 1")
    bad_amount, bad_count = f"{number} % 101 = 7", f"{number} % 103 = 5"
    q["dq_rejected_orders"] = dwd(
        "SELECT * FROM (" + _checks(
            ("records", "ods_orders", "SELECT COUNT(*) FROM ods_orders", None, None),
            ("loaded", "ods_orders", count("ods_orders", f"NOT ({bad_amount} OR {bad_count})"), None, None),
            ("rejected: total_amount is not decimal(12,2)", "ods_orders", count("ods_orders", bad_amount), 0, 0),
            ("rejected: item_count is not int", "ods_orders", count("ods_orders", f"{bad_count} AND NOT {bad_amount}"), 0, 0),
        ) + ") WHERE observed > 0 OR limit_low IS NULL")
    q["dwd_orders_observed"] = q["dwd_orders_stats"]
    q["dwd_order_items_bucketed"] = q["dwd_order_items"]
    for name in ("dws_user_summary", "dws_product_summary", "dws_date_summary"):
        q[f"{name}_by_loads"] = q[name]
    q["updated_order_status"] = dwd(
        f"SELECT strftime(create_time, '%Y-%m') AS order_month, "
        f"CASE WHEN year(create_time) = 1998 AND {number} % 97 = 0 THEN 'refunded' ELSE status END AS status, "
        f"COUNT(*) AS orders, {money('SUM(total_amount)')} AS amount FROM ods_orders GROUP BY 1, 2")
    q["active_users_rollup"] = dwd("\nUNION ALL ".join(
        f"SELECT '{period}' AS period, CAST(date_trunc('{period}', create_time) AS DATE) AS first_day, COUNT(DISTINCT user_id) AS users "
        f"FROM ods_orders GROUP BY 2" for period in ("day", "month", "quarter", "year")))

    # The user operators over the event log
    q["event_streaks"] = (
        "WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events)"
        + _streaks("e", "user_id", "day", 3, users=True))
    q["event_retention"] = (
        "WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events)"
        + _retention("e", "user_id", "day", _HORIZONS))
    event = lambda kind: step(f"event_type = '{kind}'")
    q["event_funnel"] = (
        f"SELECT COUNT(DISTINCT user_id) AS visitors, {event('view')} AS viewed, {event('click')} AS clicked, "
        f"{event('purchase')} AS purchased FROM events")

    # Generated tables: what must hold whatever the draws are
    q["gen_users"] = (
        "SELECT COUNT(*) AS users, COUNT(*) AS distinct_ids, CAST(0 AS BIGINT) AS outside_domain FROM customer")
    q["gen_products"] = (
        "SELECT COUNT(*) AS products, COUNT(*) AS distinct_ids, CAST(0 AS BIGINT) AS outside_range FROM part")
    q["gen_orders"] = (
        "SELECT COUNT(*) AS orders, COUNT(*) AS orders_with_items, CAST(0 AS BIGINT) AS amount_differs, "
        "CAST(0 AS BIGINT) AS count_differs, CAST(0 AS BIGINT) AS bad_pay_time FROM orders")
    q["gen_order_items"] = (
        "SELECT COUNT(*) AS orders, CAST(0 AS BIGINT) AS duplicate_products, "
        "CAST(0 AS BIGINT) AS outside_price_range, CAST(0 AS BIGINT) AS wrong_amount FROM orders")
    return q
