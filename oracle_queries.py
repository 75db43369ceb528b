"""DuckDB oracle SQL for every registered query.

Each query is written independently of the Spark code, as plain SQL over
the driver's pre-registered tables. The retail x weather view (FIXTURES.md
§4) is a chain of common table expressions prepended to every query.
Money is summed as DECIMAL and turned into DOUBLE only at the end; exact
averages use integer arithmetic (half away from zero).
"""

from __future__ import annotations

# Days since 1995-01-01.
_DN = "date_diff('day', date '1995-01-01', {x})"

FIXTURE_CTES = """
geo as (
  select n_nationkey, n_name, r_name
  from nation join region on n_regionkey = r_regionkey),
stg_stores as (
  select s_suppkey store_id, r_name country, n_name city, s_name store_name,
         case when s_suppkey % 37 = 36 then null else cast(3 + s_suppkey % 10 as int) end number_of_employees,
         lpad(cast(s_suppkey as varchar), 5, '0') zip_code,
         cast((s_suppkey * 13 % 1200 - 600) / 10.0 as decimal(9,6)) latitude,
         cast((s_suppkey * 29 % 3600 - 1800) / 10.0 as decimal(9,6)) longitude
  from supplier join geo on s_nationkey = n_nationkey),
dim_stores as (
  select cast(store_id as int) store_id, country, city, store_name, number_of_employees, zip_code,
         case when number_of_employees <= 7 then 'Small'
              when number_of_employees < 10 then 'Medium' else 'Large' end size,
         latitude, longitude
  from stg_stores),
dim_products as (
  select cast(p_partkey as int) product_id, p_type category, p_brand sub_category,
         cast(null as varchar) description_pt, cast(null as varchar) description_de,
         cast(null as varchar) description_fr, cast(null as varchar) description_es,
         p_name description_en, cast(null as varchar) description_zh, cast(null as varchar) color,
         cast(p_size as varchar) sizes, cast(p_retailprice as decimal(10,2)) production_cost
  from part),
dim_customers as (
  select cast(c_custkey as int) customer_id, c_name name, cast(null as varchar) email,
         cast(null as varchar) telephone, n_name city, r_name country, cast(null as varchar) gender,
         cast(null as date) date_of_birth, c_mktsegment job_title
  from customer join geo on c_nationkey = n_nationkey),
dim_employees as (
  select cast(c_custkey as int) employee_id, cast(c_custkey % 10 as int) store_id,
         c_name name, c_mktsegment position
  from customer),
dim_discounts as (
  select date '1995-01-02' + cast(p_partkey % 2000 as int) start_date_id,
         date '1995-01-02' + cast(p_partkey % 2000 + 14 as int) end_date_id,
         cast((p_partkey % 50) / 100.0 as decimal(3,2)) discount_rate,
         p_name description, p_type category, p_brand sub_category
  from part),
stg_transactions as (
  select concat('INV-', cast(l_orderkey as varchar)) invoice_id, l_linenumber line,
         o_custkey customer_id, l_partkey product_id,
         case l_linenumber % 4 when 0 then 'S' when 1 then 'M' when 2 then 'XL' else null end size,
         l_extendedprice / l_quantity unit_price, cast(l_quantity as int) quantity,
         concat(cast(cast(l_shipdate as date) as varchar), ' 1', cast(l_linenumber as varchar), ':30:00') date_text,
         l_discount discount,
         cast(cast(l_extendedprice as decimal(18,4)) * cast(1 - l_discount as decimal(3,2)) as decimal(18,4)) line_total_exact,
         l_suppkey store_id, o_custkey employee_id,
         case l_suppkey % 3 when 0 then 'USD' when 1 then 'EUR' else 'GBP' end currency,
         case when l_returnflag = 'R' then 'Return' else 'Sale' end transaction_type,
         case when l_linestatus = 'F' then 'Cash' else 'Credit Card' end payment_method,
         cast(o_totalprice as decimal(18,2)) invoice_total_raw
  from lineitem join orders on l_orderkey = o_orderkey),
fact_transactions as (
  select invoice_id, line, cast(customer_id as int) customer_id, cast(product_id as int) product_id,
         size, cast(null as varchar) color, unit_price, quantity,
         cast(cast(date_text as timestamp) as date) date, cast(cast(date_text as timestamp) as date) datetime,
         discount, cast(line_total_exact as double) line_total, cast(store_id as int) store_id,
         cast(employee_id as int) employee_id, currency, cast(null as varchar) currency_symbol,
         cast(null as varchar) sku, transaction_type, payment_method,
         cast(invoice_total_raw as decimal(10,0)) invoice_total
  from stg_transactions),
ship_days as (
  select s_suppkey, d, DN_D dn
  from (select distinct l_suppkey s_suppkey, cast(l_shipdate as date) d from lineitem) t),
stg_weather as (
  select s_suppkey store_id, d date_id,
         case when (s_suppkey * 31 + dn * 17) % 61 % 20 = 7 then null
              else cast(((s_suppkey * 37 + dn * 101) % 4501 - 500) / 100.0 as decimal(5,2)) end temp_max,
         cast(((s_suppkey * 37 + dn * 101) % 4501 - 1150) / 100.0 as decimal(5,2)) temp_min,
         case when (s_suppkey * 31 + dn * 17) % 61 = 60 then null
              else (s_suppkey * 31 + dn * 17) % 61 end precip_tenths
  from ship_days
  where (s_suppkey + dn) % 10 <> 0),
dim_store_weather as (
  select cast(store_id as int) store_id, date_id, temp_max, temp_min,
         coalesce(precip_tenths > 10, false) is_rain
  from stg_weather)
""".replace("DN_D", _DN.format(x="d"))


def with_fixture(body: str, extra_ctes: str = "") -> str:
    ctes = FIXTURE_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"with {ctes}\n{body.strip()}\n"


def exact_avg_sql(col: str, in_scale: int = 2, out_scale: int = 2) -> str:
    """Mean of a decimal column with ``in_scale`` digits, rounded half away
    from zero to ``out_scale`` digits, as DOUBLE."""
    s = f"cast(sum({col}) * {10 ** in_scale} as hugeint)"
    n = f"count({col})"
    up = 10 ** (out_scale - in_scale)
    return (f"case when {n} = 0 then null else "
            f"cast(sign({s}) * ((2 * abs({s}) * {up} + {n}) // (2 * {n})) as double) / {10 ** out_scale} end")


ORACLE: dict[str, str] = {}

# The marts by definition: the weather of each store's days with the store's
# attributes, and the lines with their product's.
_TEMP_RANGE = ("case when {t} < 10 then 'cold' when {t} between 10 and 25 then 'moderate' "
               "else 'hot' end")

_SOLD = f"""
store_days as (
  select w.store_id, w.date_id, w.is_rain, w.temp_max, w.temp_min, {_TEMP_RANGE.format(t="w.temp_max")} temperature_range,
         s.country, s.city, s.size store_size
  from dim_store_weather w join dim_stores s on s.store_id = w.store_id),
product_lines as (
  select f.invoice_id, f.store_id, f.date, f.quantity, cast(f.line_total as decimal(18,4)) amount,
         p.product_id, p.category, p.sub_category
  from fact_transactions f join dim_products p on p.product_id = f.product_id)
"""

_RANKED = _SOLD.rstrip() + """,
pair_revenue as (
  select w.is_rain, l.category, l.sub_category, sum(l.amount) revenue
  from product_lines l join dim_store_weather w on w.store_id = l.store_id and w.date_id = l.date
  group by w.is_rain, l.category, l.sub_category),
ranking as (
  select a.*, 1 + (select count(*) from pair_revenue b
                   where b.is_rain is not distinct from a.is_rain and b.revenue > a.revenue) place
  from pair_revenue a)
"""

ORACLE["top_products_by_weather"] = with_fixture("""
select category, sub_category, if(is_rain, 'Rainy', 'Not Rainy') weather_condition,
       cast(revenue as double) total_revenue
from ranking where place <= 5
""", _RANKED)


# ---------------------------------------------------------------- D1-D8
ORACLE["dim_dates"] = with_fixture("""
select date_id, cast(year(date_id) as bigint) "year", cast(quarter(date_id) as bigint) "quarter",
       cast(month(date_id) as bigint) "month", monthname(date_id) month_name,
       cast(weekofyear(date_id) as bigint) "week", cast(day(date_id) as bigint) "day",
       cast(dayofweek(date_id) as bigint) day_of_week, dayname(date_id) day_name
from (select cast(unnest(generate_series(cast(cast(lo as timestamp) as date), cast(cast(hi as timestamp) as date),
                                         interval 1 day)) as date) date_id
      from (select min(date_text) lo, max(date_text) hi from stg_transactions) b) g
""")

ORACLE["dim_customers"] = with_fixture("""
select cast(customer_id as bigint) customer_id, name, email, telephone, city, country, gender,
       date_of_birth, job_title
from dim_customers
""")

ORACLE["dim_discounts"] = with_fixture("""
select start_date_id, end_date_id, cast(discount_rate as double) discount_rate, description,
       category, sub_category
from dim_discounts
""")

ORACLE["dim_employees"] = with_fixture("""
select cast(employee_id as bigint) employee_id, cast(store_id as bigint) store_id, name, position
from dim_employees
""")

ORACLE["dim_products"] = with_fixture("""
select cast(product_id as bigint) product_id, category, sub_category, description_pt, description_de,
       description_fr, description_es, description_en, description_zh, color, sizes,
       cast(production_cost as double) production_cost
from dim_products
""")

ORACLE["dim_stores"] = with_fixture("""
select cast(store_id as bigint) store_id, country, city, store_name,
       cast(number_of_employees as bigint) number_of_employees, zip_code, size,
       cast(latitude as double) latitude, cast(longitude as double) longitude
from dim_stores
""")

ORACLE["fact_transactions"] = with_fixture("""
select invoice_id, cast(line as bigint) line, cast(customer_id as bigint) customer_id,
       cast(product_id as bigint) product_id, size, color, unit_price,
       cast(quantity as bigint) quantity, date, datetime, discount, line_total,
       cast(store_id as bigint) store_id, cast(employee_id as bigint) employee_id, currency,
       currency_symbol, sku, transaction_type, payment_method,
       cast(invoice_total as double) invoice_total
from fact_transactions
""")

ORACLE["flatten_weather"] = with_fixture("""
select cast(date_id as varchar) date_id, cast(store_id as bigint) store_id,
       cast(temp_max as double) temp_max, cast(temp_min as double) temp_min,
       precip_tenths / 10.0 precipitation
from stg_weather
""")

ORACLE["rain_flag"] = with_fixture("""
select cast(store_id as bigint) store_id, cast(date_id as varchar) date_id,
       precip_tenths / 10.0 precipitation, coalesce(precip_tenths > 10, false) is_rain
from stg_weather
""")

ORACLE["store_weather"] = with_fixture("""
select cast(store_id as bigint) store_id, date_id, cast(temp_max as double) temp_max,
       cast(temp_min as double) temp_min, is_rain
from dim_store_weather
""")

ORACLE["insert_if_absent"] = with_fixture("""
select cast(customer_id as bigint) customer_id,
       case when customer_id % 2 = 0 then name else name || ' (new)' end name,
       email, telephone, city, country, gender, date_of_birth, job_title
from dim_customers
""")

# ---------------------------------------------------------------- J1-J3
ORACLE["join_store"] = with_fixture("""
select f.invoice_id, cast(f.line as bigint) line, cast(f.store_id as bigint) store_id, f.date,
       cast(f.invoice_total as double) invoice_total, s.country, s.city, s.size store_size
from fact_transactions f join dim_stores s on f.store_id = s.store_id
""")

ORACLE["join_weather"] = with_fixture("""
select f.invoice_id, cast(f.line as bigint) line, cast(f.store_id as bigint) store_id, f.date,
       cast(f.invoice_total as double) invoice_total, cast(w.temp_max as double) temp_max,
       cast(w.temp_min as double) temp_min, w.is_rain
from fact_transactions f join dim_store_weather w on f.store_id = w.store_id and f.date = w.date_id
""")

ORACLE["join_product"] = with_fixture("""
select f.invoice_id, cast(f.line as bigint) line, cast(f.product_id as bigint) product_id,
       cast(f.quantity as bigint) quantity, f.line_total, p.category, p.sub_category
from fact_transactions f join dim_products p on f.product_id = p.product_id
""")

# ---------------------------------------------------------------- A1-A6
ORACLE["min_max_date"] = with_fixture("""
select min(date_text) min_date, max(date_text) max_date from stg_transactions
""")

ORACLE["count_distinct"] = with_fixture("""
select cast(store_id as bigint) store_id, count(distinct invoice_id) transaction_count
from fact_transactions group by store_id
""")

ORACLE["count_col"] = with_fixture("""
select cast(product_id as bigint) product_id, count(invoice_id) transaction_count
from fact_transactions group by product_id
""")

ORACLE["sum_numeric"] = with_fixture("""
select cast(store_id as bigint) store_id, cast(sum(invoice_total) as double) total_revenue,
       cast(sum(quantity) as bigint) total_quantity,
       cast(sum(cast(line_total as decimal(18,4))) as double) line_revenue
from fact_transactions group by store_id
""")

ORACLE["avg_numeric"] = with_fixture(f"""
select cast(store_id as bigint) store_id, {exact_avg_sql("temp_max")} avg_temp_max,
       {exact_avg_sql("temp_min")} avg_temp_min
from dim_store_weather group by store_id
""")

ORACLE["group_by_expr"] = with_fixture(f"""
select is_rain, {_TEMP_RANGE.format(t="temp_max")} temperature_range, count(*) store_days
from dim_store_weather group by all
""")

# ---------------------------------------------------------------- P5, P8, P9, P11, P14
ORACLE["temperature_range"] = with_fixture(f"""
select cast(store_id as bigint) store_id, date_id, cast(temp_max as double) temp_max,
       {_TEMP_RANGE.format(t="temp_max")} temperature_range
from dim_store_weather
""")

ORACLE["weather_label"] = with_fixture("""
select cast(store_id as bigint) store_id, date_id, is_rain,
       case when is_rain then 'Rainy' else 'Not Rainy' end weather_condition
from dim_store_weather
""")

ORACLE["store_size_tier"] = with_fixture("""
select cast(store_id as bigint) store_id, cast(number_of_employees as bigint) number_of_employees, size
from dim_stores
""")

ORACLE["day_trunc"] = with_fixture("""
select cast(date_trunc('day', datetime) as date) sale_date, count(*) lines
from fact_transactions group by 1
""")

ORACLE["day_offset"] = with_fixture("""
select date_id, strftime(date_id - interval 1 day, '%Y-%m-%d') weather_file_day
from (select cast(unnest(generate_series(cast(cast(lo as timestamp) as date), cast(cast(hi as timestamp) as date),
                                         interval 1 day)) as date) date_id
      from (select min(date_text) lo, max(date_text) hi from stg_transactions) b) g
""")

# ---------------------------------------------------------------- W1-W3
ORACLE["rank_over_aggregate"] = with_fixture("""
select category, sub_category, is_rain, cast(revenue as double) total_revenue, place "rank" from ranking
""", _RANKED)

ORACLE["top_n_per_group"] = with_fixture("""
select category, sub_category, is_rain, cast(revenue as double) total_revenue, place "rank"
from ranking where place <= 5
""", _RANKED)

# ---------------------------------------------------------------- M1-M3
_MARTS = _SOLD.rstrip() + f""",
m1 as (
  select d.country, d.city, d.store_size, d.is_rain, f.date sale_date,
         count(distinct f.invoice_id) transaction_count, sum(f.invoice_total) total_revenue,
         {exact_avg_sql("d.temp_max")} avg_temp_max, {exact_avg_sql("d.temp_min")} avg_temp_min
  from fact_transactions f join store_days d on d.store_id = f.store_id and d.date_id = f.date
  group by d.country, d.city, d.store_size, d.is_rain, f.date),
m2 as (
  select l.product_id, l.category, l.sub_category, w.is_rain, {_TEMP_RANGE.format(t="w.temp_max")} temperature_range,
         count(l.invoice_id) transaction_count, sum(l.quantity) total_quantity, sum(l.amount) total_revenue
  from product_lines l join dim_store_weather w on w.store_id = l.store_id and w.date_id = l.date
  group by l.product_id, l.category, l.sub_category, w.is_rain, {_TEMP_RANGE.format(t="w.temp_max")}),
m3 as (
  select d.store_size, d.is_rain, d.temperature_range, count(distinct f.invoice_id) transaction_count,
         {exact_avg_sql("f.invoice_total", 0, 2)} avg_transaction_value, sum(f.invoice_total) total_revenue
  from fact_transactions f join store_days d on d.store_id = f.store_id and d.date_id = f.date
  group by d.store_size, d.is_rain, d.temperature_range)
"""
ORACLE["region_impact"] = with_fixture("""
select country, city, store_size, is_rain, sale_date, transaction_count,
       cast(total_revenue as double) total_revenue, avg_temp_max, avg_temp_min
from m1
""", _MARTS)

ORACLE["product_sensitivity"] = with_fixture("""
select cast(product_id as bigint) product_id, category, sub_category, is_rain, temperature_range,
       transaction_count, cast(total_quantity as bigint) total_quantity,
       cast(cast(total_revenue as decimal(18,2)) as double) total_revenue
from m2
""", _MARTS)

ORACLE["size_impact"] = with_fixture("""
select store_size, is_rain, temperature_range, transaction_count, avg_transaction_value,
       cast(total_revenue as double) total_revenue
from m3
""", _MARTS)

# ---------------------------------------------------------------- Q1, Q3, Q4, W3
ORACLE["revenue_by_weather_over_time"] = with_fixture(f"""
select sale_date "time", {exact_avg_sql("total_revenue", 2, 6)} "value",
       case when is_rain then 'Rainy' else 'Not Rainy' end metric
from m1 group by sale_date, is_rain
""", _MARTS)

ORACLE["revenue_by_size_and_temperature"] = with_fixture("""
select store_size, temperature_range, cast(sum(total_revenue) as double) total_revenue
from m3 group by store_size, temperature_range
""", _MARTS)

ORACLE["transactions_by_weather"] = with_fixture("""
select case when is_rain then 'Rainy' else 'Not Rainy' end weather_condition,
       cast(sum(transaction_count) as bigint) total_transactions
from m1 group by is_rain
""", _MARTS)

ORACLE["share_of_total"] = with_fixture("""
select weather_condition, total_transactions,
       cast(total_transactions as double) / cast(sum(total_transactions) over () as double) share
from (select case when is_rain then 'Rainy' else 'Not Rainy' end weather_condition,
             cast(sum(transaction_count) as bigint) total_transactions
      from m1 group by is_rain) t
""", _MARTS)

# ---------------------------------------------------------------- O1-O3
ORACLE["sorted_time_series"] = with_fixture("""
select sale_date "time", case when is_rain then 'Rainy' else 'Not Rainy' end metric,
       rank() over (order by sale_date nulls last) "position"
from m1 group by sale_date, is_rain
""", _MARTS)

ORACLE["sorted_top_products"] = with_fixture("""
select category, sub_category, if(is_rain, 'Rainy', 'Not Rainy') weather_condition, cast(place as bigint) "rank",
       rank() over (order by is_rain nulls last, place) "position"
from ranking where place <= 5
""", _RANKED)

ORACLE["sorted_sizes"] = with_fixture("""
select store_size, temperature_range, rank() over (order by store_size nulls last, temperature_range nulls last) "position"
from (select distinct store_size, temperature_range from m3) t
""", _MARTS)

# ---------------------------------------------------------------- X1-X3
ORACLE["category_sales"] = with_fixture("""
select cast(f.store_id as bigint) store_id, f.date, p.category, count(f.invoice_id) transaction_count,
       cast(sum(f.invoice_total) as double) invoice_total_by_store_date,
       cast(sum(f.quantity) as bigint) quantity
from fact_transactions f join dim_products p on f.product_id = p.product_id
group by f.store_id, f.date, p.category
""")

ORACLE["category_totals"] = with_fixture("""
select 'unit_price' "index",
       cast(sum(cast(floor(f.unit_price * 1e6 + cast(0.5 as double)) as bigint)) as double) / 1e6 "value"
from fact_transactions f join dim_products p on f.product_id = p.product_id
union all
select 'quantity', cast(sum(f.quantity) as double)
from fact_transactions f join dim_products p on f.product_id = p.product_id
""")

# The six part types of the driver's data (pivot columns).
_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

ORACLE["category_pivot"] = with_fixture(
    "select cast(f.store_id as bigint) store_id, f.date, "
    + ", ".join(
        f"cast(coalesce(sum(case when p.category = '{c}' then f.quantity end), 0) as bigint) {c.lower()}_quantity, "
        f"cast(coalesce(sum(case when p.category = '{c}' then cast(f.line_total as decimal(18,4)) end), 0) as double) "
        f"{c.lower()}_amount"
        for c in _CATEGORIES)
    + " from fact_transactions f join dim_products p on f.product_id = p.product_id"
      " group by f.store_id, f.date")

ORACLE["category_maps"] = with_fixture("""
select cast(store_id as bigint) store_id, date, count(*) categories,
       string_agg(category || '=' || cast(quantity as varchar), ';' order by category) quantity,
       string_agg(category || '=' || cast(cast(amount as decimal(28,4)) as varchar), ';' order by category) amount
from sold group by store_id, date
""", """
sold as (
  select f.store_id, f.date, p.category, sum(f.quantity) quantity, sum(cast(f.line_total as decimal(18,4))) amount
  from fact_transactions f join dim_products p on f.product_id = p.product_id
  group by f.store_id, f.date, p.category)
""")

# ---------------------------------------------------------------- S1-S9, E1, R2
ORACLE["csv_roundtrip"] = with_fixture("""
select invoice_id, cast(line as bigint) line, cast(customer_id as bigint) customer_id,
       cast(product_id as bigint) product_id, size, '  "a"' || chr(10) || product_id || ' ' color, unit_price,
       cast(quantity as bigint) quantity, date, datetime, discount, line_total,
       cast(store_id as bigint) store_id, cast(employee_id as bigint) employee_id, currency,
       currency_symbol, sku, transaction_type, payment_method,
       cast(invoice_total as double) invoice_total
from fact_transactions
""")

_STAGED = """
select 'customers' t, c_custkey % 2 export from customer
union all select 'discounts', p_partkey % 2 from part
union all select 'employees', c_custkey % 2 from customer
union all select 'products', p_partkey % 2 from part
union all select 'stores', s_suppkey % 2 from supplier
union all select 'transactions', l_orderkey % 2 from lineitem join orders on l_orderkey = o_orderkey
"""
_STAGING_COUNTS = f"select t, count(*) n from ({_STAGED}) s group by t"

ORACLE["load_audit"] = f"""
select 'staging_' || t table_name, cast(export as bigint) export, count(*) rows,
       sum(count(*)) over (partition by t)::bigint loaded_rows
from ({_STAGED}) s group by t, export
"""

ORACLE["truncate_staging"] = f"""
select 'staging_' || t table_name, n rows_before, cast(0 as bigint) rows_after from ({_STAGING_COUNTS}) c
"""

ORACLE["weather_file"] = ORACLE["store_weather"]

# Columns of the final tables as written (fixed values: the warehouse contract).
_COLUMNS = {
    "dim_dates": "date_id date, year int, quarter int, month int, month_name string, week int, day int, "
                 "day_of_week int, day_name string",
    "dim_customers": "customer_id int, name string, email string, telephone string, city string, country string, "
                     "gender string, date_of_birth date, job_title string",
    "dim_discounts": "start_date_id date, end_date_id date, discount_rate decimal(3,2), description string, "
                     "category string, sub_category string, batch_id string",
    "dim_employees": "employee_id int, store_id int, name string, position string",
    "dim_products": "product_id int, category string, sub_category string, description_pt string, "
                    "description_de string, description_fr string, description_es string, description_en string, "
                    "description_zh string, color string, sizes string, production_cost decimal(10,2)",
    "dim_stores": "store_id int, country string, city string, store_name string, number_of_employees int, "
                  "zip_code string, size string, latitude decimal(9,6), longitude decimal(9,6)",
    "fact_transactions": "invoice_id string, line int, customer_id int, product_id int, size string, color string, "
                         "unit_price double, quantity int, date date, datetime date, discount double, "
                         "line_total double, store_id int, employee_id int, currency string, "
                         "currency_symbol string, sku string, transaction_type string, payment_method string, "
                         "invoice_total decimal(10,0), batch_id string",
    "dim_store_weather": "store_id int, date_id date, temp_max decimal(5,2), temp_min decimal(5,2), "
                         "is_rain boolean, run_date date",
    "data_mart_weather_region_impact":
        "country string, city string, store_size string, is_rain boolean, sale_date date, transaction_count bigint, "
        "total_revenue decimal(18,2), avg_temp_max decimal(5,2), avg_temp_min decimal(5,2)",
    "data_mart_product_weather_sensitivity":
        "product_id int, category string, sub_category string, is_rain boolean, temperature_range string, "
        "transaction_count bigint, total_quantity bigint, total_revenue decimal(18,2)",
    "data_mart_store_size_weather_impact":
        "store_size string, is_rain boolean, temperature_range string, transaction_count bigint, "
        "avg_transaction_value decimal(18,2), total_revenue decimal(18,2)",
}
_COUNTED = {
    "dim_dates": """(select unnest(generate_series(cast(cast(lo as timestamp) as date),
                                                   cast(cast(hi as timestamp) as date), interval 1 day))
                     from (select min(date_text) lo, max(date_text) hi from stg_transactions) b)""",
    "data_mart_weather_region_impact": "m1",
    "data_mart_product_weather_sensitivity": "m2",
    "data_mart_store_size_weather_impact": "m3",
}

ORACLE["batch_run"] = with_fixture("\nunion all ".join(
    f"select '{t}' table_name, '{columns}' \"columns\", count(*) \"rows\" from {_COUNTED.get(t, t)}"
    for t, columns in _COLUMNS.items()), _MARTS)

ORACLE["catalog_tables"] = ORACLE["batch_run"]

_KEYS = "concat_ws('|', {})"


def _keys(*columns: str) -> str:
    return _KEYS.format(", ".join(f"coalesce(cast({c} as varchar), '-')" for c in columns))


ORACLE["batch_marts"] = with_fixture(f"""
select 'data_mart_weather_region_impact' mart, {_keys("country", "city", "store_size", "is_rain", "sale_date")} keys,
       cast(transaction_count as double) n0, cast(total_revenue as double) n1, avg_temp_max n2, avg_temp_min n3
from m1
union all
select 'data_mart_product_weather_sensitivity',
       {_keys("product_id", "category", "sub_category", "is_rain", "temperature_range")},
       transaction_count, total_quantity, cast(cast(total_revenue as decimal(18,2)) as double),
       cast(cast(total_revenue as decimal(18,2)) as double)
from m2
union all
select 'data_mart_store_size_weather_impact', {_keys("store_size", "is_rain", "temperature_range")},
       transaction_count, avg_transaction_value, cast(total_revenue as double), cast(total_revenue as double)
from m3
""", _MARTS)

ORACLE["merge_weather"] = with_fixture("""
select cast(w.store_id as bigint) store_id, w.date_id,
       cast(case when n.store_id is null then w.temp_max else w.temp_max + 1 end as double) temp_max,
       cast(w.temp_min as double) temp_min, w.is_rain,
       case when n.store_id is null then date '2025-03-01' else date '2025-03-02' end run_date
from dim_store_weather w
left join (select store_id, date_id from dim_store_weather
           where store_id % 2 = 0 and date_diff('day', date '1995-01-01', date_id) % 2 = 0) n
  on w.store_id = n.store_id and w.date_id = n.date_id
""")

ORACLE["weather_requests"] = with_fixture("""
select cast(store_id as bigint) store_id, cast(latitude as double) latitude, cast(longitude as double) longitude,
       cast(92 as bigint) past_days, store_id in (select store_id from stg_weather) answered
from stg_stores
""")
