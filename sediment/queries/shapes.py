"""SQL of the conformed tables, used inside the oracle statements."""

from __future__ import annotations

CUSTOMERS = """
  select c.c_custkey as customer_id, c.c_name as name,
         lower(replace(c.c_name, '#', '_')) || '@example.com' as email,
         n.n_name as country, c.c_mktsegment as segment
  from customer c join nation n on c.c_nationkey = n.n_nationkey"""

PRODUCTS = """
  select p_partkey as product_id, p_name as name, p_type as category,
         p_retailprice as price, p_size as inventory_count
  from part"""

ORDERS = """
  select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date,
         o_totalprice as total_amount,
         case o_orderstatus when 'P' then 'Cancelled' when 'F' then 'Delivered' else 'Pending' end as status
  from orders"""

ORDER_ITEMS = """
  select concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) as order_item_id,
         l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
         floor(l_extendedprice * 100 / l_quantity) / 100 as unit_price, l_shipdate as ship_date
  from lineitem"""


def daily_sales(orders: str) -> str:
    return f"""
  select cast(order_date as date) as order_date,
         cast(sum(cast(total_amount as decimal(18,2))) as double) as total_revenue,
         count(order_id) as orders_count,
         cast(sum(cast(total_amount as decimal(18,2))) as double) / count(total_amount) as average_order_value,
         count(*) filter (where status = 'Cancelled') as cancelled_orders_count
  from ({orders}) group by 1"""


def customer_metrics(orders: str, customers: str = CUSTOMERS) -> str:
    return f"""
  select c.customer_id, c.name as customer_name, c.email, c.country, a.total_orders, a.total_spent,
         a.first_order_date, a.last_order_date
  from (select customer_id, count(order_id) as total_orders,
               cast(sum(cast(total_amount as decimal(18,2))) as double) as total_spent,
               min(order_date) as first_order_date, max(order_date) as last_order_date
        from ({orders}) group by 1) a
  join ({customers}) c on a.customer_id = c.customer_id"""


def category_performance(order_items: str, products: str = PRODUCTS) -> str:
    return f"""
  select p.category, cast(sum(i.quantity) as bigint) as units_sold,
         cast(sum(i.quantity * cast(i.unit_price as decimal(18,2))) as double) as revenue_generated
  from ({order_items}) i join ({products}) p on i.product_id = p.product_id
  group by 1"""


def merged(target: str, source: str, key: str, updated: list[str], kept: list[str]) -> str:
    """The target after a merge, as a full join with presence flags."""
    columns = [f"case when t.{key} is not null then t.{key} else s.{key} end as {key}"]
    columns += [f"case when s.in_source then s.{c} else t.{c} end as {c}" for c in updated]
    columns += [f"case when t.in_target then t.{c} else s.{c} end as {c}" for c in kept]
    return f"""
  select {', '.join(columns)}
  from (select *, true as in_target from ({target})) t
  full join (select *, true as in_source from ({source})) s on t.{key} = s.{key}"""
