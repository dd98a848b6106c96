"""ANSI SQL for each fixture query, to be run by another engine over the same tables."""

from __future__ import annotations

# Shared request shapes, used by more than one oracle.
_BOOKING = """
r as (
  select event_id as req_id, event_type, value, user_id * 15 as client_id, cast(floor(value / 3) as integer) as table_id
  from events),
g as (
  select r.req_id, r.client_id, r.table_id,
    case when not r.value > 5 then 422 when r.event_type = 'error' then 403
         when n.n_nationkey is null then 404 when c.c_custkey is null then 404 else 0 end as gate
  from r left join nation n on n.n_nationkey = r.table_id left join customer c on c.c_custkey = r.client_id),
w as (
  select client_id, table_id, min(req_id) as winner from g
  where gate = 0 and not exists (
    select 1 from customer b where b.c_custkey = g.client_id and b.c_nationkey = g.table_id)
  group by client_id, table_id),
o as (
  select g.req_id, case when g.gate <> 0 then g.gate when w.winner = g.req_id then 201 else 409 end as status
  from g left join w on w.client_id = g.client_id and w.table_id = g.table_id)
"""

_APPLY_INSERTS = f"with {_BOOKING} select req_id, status from o"

_FK_CHECK = """
with r as (
  select event_id as req_id, user_id * 15 as client_id,
    case when event_type <> 'view' then cast(floor(value) as integer) end as table_id
  from events)
select r.req_id,
  case when r.table_id is not null and n.n_nationkey is null then 'table' when c.c_custkey is null then 'client'
       else 'ok' end as fk
from r left join nation n on n.n_nationkey = r.table_id left join customer c on c.c_custkey = r.client_id
"""

_ROLES = """
with r as (
  select event_id as req_id,
    list_sort(list_distinct([event_type, 'view', case when value > 10 then 'admin' else 'view' end])) as roles
  from events)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "scan_typed": "select o_orderkey as order_id, o_custkey as client_id, o_orderpriority as order_type from orders",
        "project_response": "select c_custkey, c_name, c_nationkey, c_acctbal from customer",
        "append_accepted": f"with {_BOOKING} select req_id, status from o where status = 201",
        "decode_bodies": """
            with r as (
              select event_id as req_id, event_type, value,
                case when value < 10 then null when value < 20 then null when value < 30 then null
                     else event_type end as dish_name,
                cast(value as decimal(10,2)) as price,
                case when event_type <> 'click' then cast(user_id as integer) end as restaurant_id,
                case when value >= 20 and value < 30 then 0 else 1 end as sent_name
              from events)
            select req_id, dish_name, price, restaurant_id, sent_name,
              concat_ws(';',
                case when value < 10 then 'dish_name:missing' end,
                case when length(dish_name) > 6 then 'dish_name:max_length' end,
                case when value >= 20 and value < 30 then 'dish_name:missing' end,
                case when value >= 10 and value < 20 then 'dish_name:type' end,
                case when not value > 0 then 'price:gt' end,
                case when not restaurant_id > 0 then 'restaurant_id:gt' end,
                case when event_type = 'click' then 'restaurant_id:type' end) as errors
            from r""",
        "lookup_by_key": """
            select e.event_id as req_id, e.user_id * 20 as key, c.c_name as user_name,
              case when c.c_custkey is null then 404 else 200 end as status
            from events e left join customer c on c.c_custkey = e.user_id * 20""",
        "lookup_touched": """
            select s.s_suppkey as req_id, s.s_suppkey * 300 as key, o.o_custkey as client_id,
              case when o.o_orderkey is null then 404 else 200 end as status
            from supplier s left join orders o on o.o_orderkey = s.s_suppkey * 300""",
        "lookup_by_alt_key": """
            with r as (
              select p_partkey as req_id, case when p_size > 40 then concat(p_name, ' deluxe') else p_name end as name
              from part),
            f as (select p_name, min(p_partkey) as first_id from part group by p_name)
            select r.req_id, r.name, f.first_id, case when f.p_name is null then 404 else 200 end as status
            from r left join f on f.p_name = r.name""",
        "taken_by_other": """
            select p.p_partkey as id from part p where exists (
              select 1 from part q
              where q.p_brand = p.p_brand and q.p_name = p.p_name and q.p_partkey <> p.p_partkey)""",
        "owner_or_admin": """
            select event_id as req_id,
              case when event_type = 'purchase' or user_id = cast(floor(value) as bigint) then 200 else 403 end as status
            from events""",
        "validate_rows": """
            select c_custkey as id, concat_ws(';',
              case when not c_acctbal > 0 then 'price:gt' end,
              case when length(c_mktsegment) > 8 then 'name:max_length' end,
              case when c_nationkey not between 0 and 20 then 'status:range' end) as errors
            from customer""",
        "coerce_types": """
            select l_orderkey as order_id, l_partkey as menu_id, l_linenumber as n,
              case when l_linenumber not in (2, 3) then cast(l_quantity as integer) end as quantity,
              case when l_tax = floor(l_tax) then cast(l_tax as integer) end as portions,
              cast(l_extendedprice as decimal(10,2)) as price,
              case when l_linenumber not in (3, 4) then strftime(l_shipdate - interval 2 hour, '%Y-%m-%d %H:%M:%S') end as "at"
            from lineitem""",
        "check_email": """
            with r as (
              select c_custkey as req_id, concat(
                replace(lower(c_name), '#', case when c_nationkey < 8 then '' else '@' end),
                case when c_mktsegment = 'BUILDING' then '' when c_mktsegment = 'MACHINERY' then ' .com'
                     else '.com' end) as email
              from customer)
            select req_id, email,
              case when email like '%_@_%._%' and email not like '%@%@%' and email not like '% %' then 201
                   else 422 end as status
            from r""",
        "fill_defaults": """
            select event_id as id,
              coalesce(case when value < 30 then null when value < 60 then 0 else 2 end, 1) as table_status
            from events""",
        "fk_check": _FK_CHECK,
        "fk_orphans": """
            select o_orderkey as order_id, o_custkey + 100 as client_id from orders o
            where not exists (select 1 from customer c where c.c_custkey = o.o_custkey + 100)""",
        "navigate_to_one": """
            select l.l_orderkey as order_id, l.l_linenumber as n, p.p_name as dish_name, o.o_custkey as client_id,
              l.l_quantity as quantity
            from lineitem l join orders o on o.o_orderkey = l.l_orderkey join part p on p.p_partkey = l.l_partkey""",
        "navigate_to_many": """
            select o.o_orderkey as order_id, l.l_linenumber as n, l.l_partkey as menu_id, l.l_quantity as quantity
            from orders o left join lineitem l on l.l_orderkey = o.o_orderkey""",
        "children_summary": """
            select o.o_orderkey as order_id, count(l.l_orderkey) as n_items, min(l.l_partkey) as first_menu,
              max(l.l_partkey) as last_menu
            from orders o left join lineitem l on l.l_orderkey = o.o_orderkey group by o.o_orderkey""",
        "insert_with_lookup_value": """
            select c_custkey as user_id, c_name as user_name,
              (select r_regionkey from region where r_name = 'ASIA') as role_id
            from customer""",
        "unique_conflict": """
            with r as (
              select event_id as req_id, user_id * 10 as client, cast(floor(value) as integer) as number from events)
            select req_id,
              case when exists (select 1 from customer c where c.c_custkey = r.client and c.c_nationkey = r.number) then 409
                   when row_number() over (partition by client, number order by req_id) > 1 then 409
                   else 201 end as status
            from r""",
        "duplicate_keys": """
            select l_orderkey as order_id, l_linenumber as n, count(*) as copies from lineitem
            group by l_orderkey, l_linenumber having count(*) > 1""",
        "insert_if_absent": """
            with b as (
              select user_id * 20 as user_id, concat('guest ', event_type) as user_name,
                row_number() over (partition by user_id order by event_id) as rn
              from events)
            select c_custkey as user_id, c_name as user_name from customer
            union all
            select user_id, user_name from b
            where rn = 1 and not exists (select 1 from customer c where c.c_custkey = b.user_id)""",
        "assign_ids": """
            select (select max(o_orderkey) from orders) + row_number() over (order by event_id) as order_id,
              event_id as req_id
            from events""",
        "apply_inserts": _APPLY_INSERTS,
        "apply_patch": """
            with p as (
              select event_id as seq, user_id * 7 as id, event_type in ('click', 'view') as has_seg,
                case when value >= 20 then event_type end as seg, value > 50 as has_bal, value as bal
              from events),
            s as (
              select id, max(case when has_seg then seq end) as seg_seq, max(case when has_bal then seq end) as bal_seq
              from p group by id)
            select c.c_custkey as id, case when s.seg_seq is not null then ps.seg else c.c_mktsegment end as seg,
              case when s.bal_seq is not null then pb.bal else c.c_acctbal end as bal
            from customer c left join s on s.id = c.c_custkey left join p ps on ps.seq = s.seg_seq
              left join p pb on pb.seq = s.bal_seq""",
        "patch_outcome": """
            with r as (
              select event_id as req_id, user_id * 20 as target, event_type,
                event_type in ('click', 'purchase') as has_name,
                concat('Customer#', lpad(cast(cast(floor(value) as bigint) * 20 as varchar), 9, '0')) as new_name,
                event_type = 'signup' as has_nation, cast(floor(value / 3) as integer) as new_nation,
                value < 2 or value > 100 as has_seg, case when value >= 2 then 'BUILDING' end as new_seg
              from events),
            b as (
              select r.*, c.c_name,
                case when r.event_type = 'error' then 403 when c.c_custkey is null then 404
                     when not (has_name or has_nation or has_seg) then 400
                     when has_nation and n.n_nationkey is null then 404
                     when has_seg and new_seg is null then 409 else 0 end as gate
              from r left join customer c on c.c_custkey = r.target left join nation n on n.n_nationkey = r.new_nation),
            w as (
              select new_name, min(req_id) as winner from b
              where gate = 0 and has_name and new_name <> c_name
                and not exists (select 1 from customer q where q.c_name = b.new_name)
              group by new_name)
            select b.req_id,
              case when gate <> 0 then gate
                   when has_name and b.new_name <> c_name and w.winner is distinct from b.req_id then 409
                   else 200 end as status
            from b left join w on w.new_name = b.new_name""",
        "delete_by_key": """
            select o_orderkey as order_id, o_custkey as client_id from orders o
            where not exists (select 1 from events e where e.event_id * 2 = o.o_orderkey)""",
        "delete_outcome": """
            with b as (
              select e.event_id as req_id, e.user_id * 20 as target,
                case when e.event_type = 'error' then 403 when c.c_custkey is null then 404
                     when exists (
                       select 1 from orders o where o.o_custkey * 3 = e.user_id * 20) then 409
                     else 0 end as gate
              from events e left join customer c on c.c_custkey = e.user_id * 20),
            w as (select target, min(req_id) as winner from b where gate = 0 group by target)
            select b.req_id, case when gate <> 0 then gate when w.winner = b.req_id then 204 else 404 end as status
            from b left join w on w.target = b.target""",
        "delete_cascade": """
            select l.l_orderkey as order_id, l.l_linenumber as n, l.l_partkey as menu_id, l.l_suppkey as s
            from lineitem l
            where not exists (select 1 from supplier s where s.s_suppkey = l.l_suppkey and s.s_acctbal < 0)""",
        "delete_restrict": """
            select o.o_orderkey as order_id,
              case when exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey) then 'restricted'
                   else 'deleted' end as outcome
            from orders o""",
        "delete_detach": """
            select o.o_orderkey as order_id,
              case when c.c_mktsegment = 'BUILDING' then null else o.o_custkey end as table_id
            from orders o join customer c on c.c_custkey = o.o_custkey""",
        "update_profile": """
            with r as (
              select p_partkey as req_id, p_partkey + case when p_type = 'MEDIUM' then 1 else 0 end as target,
                case when p_type <> 'ECONOMY' then p_partkey end as caller, p_brand = 'Brand#1' as admin,
                case when p_size < 25 then 'red widget' when p_size < 40 then concat(p_name, ' xl') end as name,
                case when p_size > 45 then p_size + 1 end as role
              from part),
            b as (
              select r.*, u.p_name as old_name, u.p_brand as brand,
                case when r.caller is null then 401 when u.p_partkey is null then 404
                     when r.caller <> u.p_partkey and not r.admin then 403
                     when r.role <> u.p_size then 403
                     when exists (
                       select 1 from part q
                       where q.p_brand = u.p_brand and q.p_name = r.name and q.p_partkey <> u.p_partkey) then 400
                     else 0 end as gate
              from r left join part u on u.p_partkey = r.target),
            w as (
              select brand, name, min(req_id) as winner from b
              where gate = 0 and name is not null and name <> old_name group by brand, name)
            select b.req_id,
              case when gate <> 0 then gate when b.name <> old_name and w.winner <> b.req_id then 400 else 200 end as status
            from b left join w on w.brand = b.brand and w.name = b.name""",
        "children_pages": """
            with r as (
              select o_custkey, o_orderkey, o_orderstatus, o_orderdate,
                row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as rank from orders),
            p as (
              select o_custkey, cast(rank // 8 as integer) as page,
                string_agg(o_orderkey || ':' || o_orderstatus, ',' order by rank) as children
              from r group by 1, 2)
            select c_custkey, coalesce(page, 0) as page, coalesce(children, '') as children
            from customer left join p on o_custkey = c_custkey""",
        "register_users": """
            with b as (
              select event_id as req_id,
                concat('Customer#', lpad(cast(user_id * 20 as varchar), 9, '0')) as user_name,
                case when value < 2 then 422 else 0 end as gate
              from events),
            w as (
              select user_name, min(req_id) as winner from b
              where gate = 0 and not exists (select 1 from customer c where c.c_name = b.user_name) group by user_name),
            o as (
              select b.req_id, b.user_name,
                case when gate <> 0 then gate when w.winner = b.req_id then 201 else 400 end as status
              from b left join w on w.user_name = b.user_name)
            select req_id, status, user_name,
              case when status = 201 then (select r_regionkey from region where r_name = 'EUROPE') end as role_id
            from o""",
        "roles_union": f"{_ROLES} select req_id, array_to_string(roles, ',') as roles from r",
        "require_role": f"""{_ROLES}
            select req_id, case when list_contains(roles, 'admin') then 200 else 403 end as status from r""",
        "location_id": """
            with r as (
              select page_id, case when url like '%?%' then '' else url end as url from pages)
            select r.page_id, case when r.url = '' then c.c_name else split_part(r.url, '/', -1) end as found_id
            from r left join customer c on c.c_custkey = r.page_id""",
        "kid_match": """
            with r as (
              select event_id as req_id,
                case when event_type <> 'view' then cast(floor(value / 2) as integer) end as kid
              from events)
            select r.req_id, n.n_name as key_name, case when n.n_nationkey is null then 401 else 200 end as status
            from r left join nation n on n.n_nationkey = r.kid""",
        "claims_filter": """
            select event_id as req_id from events
            where event_type = 'click' and user_id < 50 and event_id >= 50 and value <= 80""",
        "login_outcome": """
            with r as (
              select event_id as req_id, case when event_type = 'click' then 200 else 401 end as code,
                case when event_type = 'view' then 'Account is not fully set up: resolve_required_actions'
                     when event_type = 'error' then '' end as descr, 'invalid_grant' as err
              from events)
            select req_id,
              case when code = 200 then 200
                   when coalesce(nullif(descr, ''), err) like '%resolve_required_actions%' then 403 else 401 end as status
            from r""",
        "constraint_audit": """
            select 'customer' as table_name, 'pk' as rule, count(*) as violations
              from (select 1 from customer group by c_custkey having count(*) > 1)
            union all select 'customer', 'c_custkey:missing', count(*) from customer where c_custkey is null
            union all select 'customer', 'c_name:missing', count(*) from customer where c_name is null
            union all select 'customer', 'c_nationkey:missing', count(*) from customer where c_nationkey is null
            union all select 'customer', 'c_nationkey:range', count(*) from customer where c_nationkey not between 0 and 20
            union all select 'customer', 'c_acctbal:missing', count(*) from customer where c_acctbal is null
            union all select 'customer', 'c_acctbal:gt', count(*) from customer where not c_acctbal > 0
            union all select 'customer', 'c_mktsegment:missing', count(*) from customer where c_mktsegment is null
            union all select 'customer', 'c_mktsegment:max_length', count(*) from customer where length(c_mktsegment) > 8
            union all select 'orders', 'pk', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)
            union all select 'orders', 'fk:o_custkey', count(*) from orders o
              where not exists (select 1 from customer c where c.c_custkey = o.o_custkey)
            union all select 'orders', 'o_orderkey:missing', count(*) from orders where o_orderkey is null
            union all select 'orders', 'o_custkey:missing', count(*) from orders where o_custkey is null
            union all select 'orders', 'o_orderpriority:missing', count(*) from orders where o_orderpriority is null
            union all select 'part', 'pk', count(*) from (select 1 from part group by p_partkey having count(*) > 1)
            union all select 'part', 'p_partkey:missing', count(*) from part where p_partkey is null
            union all select 'part', 'unique:p_brand,p_name', count(*)
              from (select 1 from part group by p_brand, p_name having count(*) > 1)
            union all select 'lineitem', 'pk', count(*)
              from (select 1 from lineitem group by l_orderkey having count(*) > 1)
            union all select 'lineitem', 'unique:l_orderkey,l_linenumber', count(*)
              from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
            union all select 'lineitem', 'fk:menu_id', count(*) from lineitem l
              where not exists (select 1 from part p where p.p_partkey = l.l_partkey + 100)
            union all select 'lineitem', 'l_orderkey:missing', count(*) from lineitem where l_orderkey is null
            union all select 'lineitem', 'l_quantity:missing', count(*) from lineitem where l_quantity is null
            union all select 'lineitem', 'l_quantity:gt', count(*) from lineitem where not l_quantity > 1
            union all select 'events', 'pk', count(*)
              from (select 1 from events where value >= 5 group by event_id having count(*) > 1)
            union all select 'events', 'event_id:missing', count(*) from events where not coalesce(value >= 5, false)
            union all select 'events', 'ts:missing', count(*) from events where ts is null
            union all select 'events', 'user_id:missing', count(*) from events where user_id is null
            union all select 'events', 'event_type:missing', count(*) from events where event_type is null
            union all select 'events', 'value:missing', count(*) from events where value is null
            union all select 'events', 'props:missing', count(*) from events where props is null""",
        # The audit of the tables as both change sets leave them.
        "audit_change": """
            with customer_left as (
              select * from customer c where not exists (select 1 from events e where e.user_id = c.c_custkey)
            ), orders_left as (
              select * from orders o where not exists (select 1 from events e where e.event_id * 2 = o.o_orderkey)
            ), part_more as (
              select p_partkey, p_brand, p_name from part
              union all select event_id, event_type, 'Part#' || user_id from events
            ), lineitem_more as (
              select l_orderkey, l_linenumber, l_quantity, l_partkey + 100 as menu_id from lineitem
              union all select event_id * 2, 1, value, user_id from events
            )
            select 'customer' as table_name, 'pk' as rule, count(*) as violations
              from (select 1 from customer_left group by c_custkey having count(*) > 1)
            union all select 'customer', 'c_custkey:missing', count(*) from customer_left where c_custkey is null
            union all select 'customer', 'c_name:missing', count(*) from customer_left where c_name is null
            union all select 'customer', 'c_nationkey:missing', count(*) from customer_left where c_nationkey is null
            union all select 'customer', 'c_nationkey:range', count(*) from customer_left where c_nationkey not between 0 and 20
            union all select 'customer', 'c_acctbal:missing', count(*) from customer_left where c_acctbal is null
            union all select 'customer', 'c_acctbal:gt', count(*) from customer_left where not c_acctbal > 0
            union all select 'customer', 'c_mktsegment:missing', count(*) from customer_left where c_mktsegment is null
            union all select 'customer', 'c_mktsegment:max_length', count(*) from customer_left where length(c_mktsegment) > 8
            union all select 'orders', 'pk', count(*) from (select 1 from orders_left group by o_orderkey having count(*) > 1)
            union all select 'orders', 'fk:o_custkey', count(*) from orders_left o
              where not exists (select 1 from customer_left c where c.c_custkey = o.o_custkey)
            union all select 'orders', 'o_orderkey:missing', count(*) from orders_left where o_orderkey is null
            union all select 'orders', 'o_custkey:missing', count(*) from orders_left where o_custkey is null
            union all select 'orders', 'o_orderpriority:missing', count(*) from orders_left where o_orderpriority is null
            union all select 'part', 'pk', count(*) from (select 1 from part_more group by p_partkey having count(*) > 1)
            union all select 'part', 'p_partkey:missing', count(*) from part_more where p_partkey is null
            union all select 'part', 'unique:p_brand,p_name', count(*)
              from (select 1 from part_more group by p_brand, p_name having count(*) > 1)
            union all select 'lineitem', 'pk', count(*)
              from (select 1 from lineitem_more group by l_orderkey having count(*) > 1)
            union all select 'lineitem', 'unique:l_orderkey,l_linenumber', count(*)
              from (select 1 from lineitem_more group by l_orderkey, l_linenumber having count(*) > 1)
            union all select 'lineitem', 'fk:menu_id', count(*) from lineitem_more l
              where not exists (select 1 from part_more p where p.p_partkey = l.menu_id)
            union all select 'lineitem', 'l_orderkey:missing', count(*) from lineitem_more where l_orderkey is null
            union all select 'lineitem', 'l_quantity:missing', count(*) from lineitem_more where l_quantity is null
            union all select 'lineitem', 'l_quantity:gt', count(*) from lineitem_more where not l_quantity > 1
            union all select 'events', 'pk', count(*)
              from (select 1 from events where value >= 5 group by event_id having count(*) > 1)
            union all select 'events', 'event_id:missing', count(*) from events where not coalesce(value >= 5, false)
            union all select 'events', 'ts:missing', count(*) from events where ts is null
            union all select 'events', 'user_id:missing', count(*) from events where user_id is null
            union all select 'events', 'event_type:missing', count(*) from events where event_type is null
            union all select 'events', 'value:missing', count(*) from events where value is null
            union all select 'events', 'props:missing', count(*) from events where props is null""",
        "stream_fk_check": _FK_CHECK,
        "stream_apply": _APPLY_INSERTS,
        "stream_compact": _APPLY_INSERTS,
        "publish_version": """
            select o_orderkey, o_custkey from orders o
            where not exists (select 1 from events e where e.event_id * 2 = o.o_orderkey)""",
    }
