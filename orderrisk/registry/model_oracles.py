"""SQL that checks the model inputs and samples. Fits and explanations are checked by tests."""

from __future__ import annotations

from .oracle_base import with_mart

_DUMMIES = [
    ("payment_method", "discover"),
    ("payment_method", "mastercard"),
    ("payment_method", "visa"),
    ("product_category", "Electronics"),
    ("product_category", "Home & Garden"),
    ("product_category", "Services"),
    ("product_category", "Travel"),
]
_NUMBERS = [
    "order_amount",
    "order_hour",
    "account_age_days",
    "orders_on_day",
    "customer_avg_order_amount",
    "customer_ip_mismatch_count",
    "is_new_customer",
    "country_mismatch",
    "ip_mismatch",
    "high_velocity",
]
NAMES = _NUMBERS + [f"{column}_{word}" for column, word in _DUMMIES]

FEATURE_SQL = f"""
inputs as (
  select order_id, is_fraud, {", ".join(f"cast({c} as double) as {c}" for c in _NUMBERS)},
    {", ".join(f'case when {c} = {chr(39)}{w}{chr(39)} then 1.0::double else 0.0::double end as "{c}_{w}"' for c, w in _DUMMIES)}
  from mart)"""


def key_hash(salt: str) -> str:
    return f"('0x' || substr(md5(cast(order_id as varchar) || '{salt}'), 1, 15))::bigint"


_SPLIT = f"""
sizes as (
  select is_fraud, n, (total + 4) // 5 as wanted, n * ((total + 4) // 5) // total as part,
    (n * ((total + 4) // 5)) % total as remainder
  from (select is_fraud, count(*) as n, (select count(*) from mart) as total from mart group by 1)),
quotas as (
  select is_fraud, part + case when row_number() over (order by remainder desc, is_fraud)
      <= wanted - (select sum(part) from sizes) then 1 else 0 end as quota from sizes),
split as (
  select m.order_id, m.is_fraud,
    row_number() over (partition by m.is_fraud order by {key_hash("").replace("order_id", "m.order_id")}, m.order_id)
      <= q.quota as is_test
  from mart m join quotas q on m.is_fraud = q.is_fraud)"""

_SCALED = ", ".join(
    f"""round((i."{n}" - avg(i."{n}") filter (where not is_test) over ())
      / coalesce(nullif(stddev_pop(i."{n}") filter (where not is_test) over (), 0), 1), 6) as "{n}\""""
    for n in NAMES
)

_Z = [f"z{i}" for i in range(len(NAMES))]


def _tag_hash(salt: str) -> str:
    return f"('0x' || substr(md5(id || '-' || copy || '{salt}'), 1, 15))::bigint"


# Oversampling by brute force: all pairs of distinct positives, ranked.
_SMOTE = f"""
z_rows as (
  select i.order_id, i.is_fraud, s.is_test, {", ".join(
    f"""(i."{n}" - avg(i."{n}") filter (where not is_test) over ())
      / coalesce(nullif(stddev_pop(i."{n}") filter (where not is_test) over (), 0), 1) as z{i}"""
    for i, n in enumerate(NAMES))}
  from inputs i join split s on i.order_id = s.order_id),
z_train as (select * from z_rows where not is_test),
need as (
  select count(*) filter (where is_fraud = 1) as pos,
    greatest(count(*) filter (where is_fraud = 0) - count(*) filter (where is_fraud = 1), 0) as missing
  from z_train),
extra as (
  select *, row_number() over (order by {key_hash("smote")}, order_id) <= (select missing % pos from need) as more
  from z_train where is_fraud = 1),
points as (
  select min(order_id) as id, count(*) as mult,
    count(*) * (select missing // pos from need) + count(*) filter (where more) as copies, {", ".join(_Z)}
  from extra group by {", ".join(_Z)}),
near as (
  select a.id, b.id as nid, b.mult, row_number() over (partition by a.id
    order by sqrt({" + ".join(f"(a.{z} - b.{z}) * (a.{z} - b.{z})" for z in _Z)}), b.id) as place
  from points a join points b on a.id <> b.id),
slots as (
  select id, nid, row_number() over (partition by id order by place, again) - 1 as slot from (
    select id, id as nid, 0 as place, unnest(range(0, least(mult - 1, 5))) as again from points
    union all
    select id, nid, place, unnest(range(0, least(mult, 5))) as again from near where place <= 5)
  qualify slot < 5),
sizes_of as (select id, count(*) as size from slots group by 1),
made as (select id, unnest(range(1, copies + 1)) as copy from points where copies > 0),
drawn as (
  select m.id, m.copy, {_tag_hash("neighbour").replace("id ||", "m.id ||")} % size as slot,
    {_tag_hash("position").replace("id ||", "m.id ||")}::double / 1152921504606846976.0::double as at
  from made m join sizes_of s on m.id = s.id)"""

_SMOTE_ROWS = f""" select order_id, cast(0 as bigint) as copy, is_fraud,
    {", ".join(f'round(z{i}, 6) as "{n}"' for i, n in enumerate(NAMES))} from z_train
  union all
  select d.id, d.copy, 1, {", ".join(f'round(a.z{i} + (b.z{i} - a.z{i}) * d.at, 6)' for i in range(len(NAMES)))}
  from drawn d join points a on d.id = a.id join slots s on d.id = s.id and d.slot = s.slot
    join points b on s.nid = b.id"""

ORACLES = {
    "smote_oversample": with_mart(FEATURE_SQL, _SPLIT, _SMOTE) + _SMOTE_ROWS,
    "feature_matrix": with_mart(FEATURE_SQL) + " select * from inputs",
    "stratified_split": with_mart(_SPLIT) + " select * from split",
    "standard_scale": with_mart(FEATURE_SQL, _SPLIT)
    + f" select i.order_id, s.is_test, {_SCALED} from inputs i join split s on i.order_id = s.order_id",
    "class_weights": with_mart(_SPLIT)
    + """ select is_fraud, count(*) as orders,
        (select count(*) from split where not is_test)::double / (2 * count(*)) as balanced_weight,
        case when is_fraud = 1 then (select count(*) from split where not is_test and is_fraud = 0)::double / count(*)
          else 1.0::double end as boost_weight
      from split where not is_test group by 1""",
    "undersample": with_mart(_SPLIT)
    + f""" select order_id, is_fraud from (
        select order_id, is_fraud, row_number() over (partition by is_fraud order by {key_hash("under")}, order_id) as rn
        from split where not is_test)
      where is_fraud = 1 or rn <= (select count(*) from split where not is_test and is_fraud = 1)""",
    "shap_sample": with_mart(_SPLIT)
    + f""" select order_id, is_fraud from split where is_test
      order by {key_hash("sample")}, order_id limit 5000""",
}
