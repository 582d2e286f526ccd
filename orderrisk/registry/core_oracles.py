"""SQL that checks the core queries, written independently of the Spark plans."""

from __future__ import annotations

from orderrisk.functions import fixed_values as fixed

from .oracle_base import (
    PREDICTIONS,
    RULES,
    h,
    percent,
    ratio,
    with_cards,
    with_mart,
    with_stage,
    with_variant,
)

_RULE_SQL = RULES
_REPORT_LABELS = fixed.REPORT_RULE_LABELS
_EXPLORE_LABELS = fixed.EXPLORE_RULE_LABELS


def _hits(condition: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint)"


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


_RULE_HITS = _union(
    [f"select '{label}' as rule, {_hits(_RULE_SQL[name][0])} as hits from mart" for name, label in _REPORT_LABELS.items()]
)

_FLAGGED = """
flagged as (
  select f.order_id, f.customer_id, f.order_date, f.order_amount, f.payment_method, f.product_category,
    f.billing_country, f.shipping_country, f.ip_country, f.risk_score, f.risk_tier,
    coalesce(m.ml_fraud_prob, 0.0) as ml_fraud_prob, coalesce(m.ml_fraud_flag, 0) as ml_fraud_flag
  from mart f left join preds m using (order_id) where f.fraud_flag = 1
  order by coalesce(m.ml_fraud_prob, 0.0) desc, f.order_id limit 50)"""


def _curve(score: str = "risk_score", name: str = "cum") -> str:
    """Cumulative label counts per distinct score, by a self join instead of a window."""
    return f"""
{name}_counts as (
  select {score} as threshold, cast(sum(is_fraud) as bigint) as pos,
    cast(sum(1 - is_fraud) as bigint) as neg from mart group by 1),
{name} as (
  select a.threshold, a.pos, a.neg, cast(sum(b.pos) as bigint) as tp, cast(sum(b.neg) as bigint) as fp,
    (select cast(sum(is_fraud) as bigint) from mart) as all_pos,
    (select cast(sum(1 - is_fraud) as bigint) from mart) as all_neg
  from {name}_counts a join {name}_counts b on b.threshold >= a.threshold group by 1, 2, 3)"""


def _auc(name: str = "cum") -> str:
    return (
        f"(select cast(sum(neg * (2 * tp - pos)) as double) / (max(all_pos)::double * max(all_neg)::double * 2)"
        f" from {name})"
    )


def _ap(name: str = "cum") -> str:
    return f"(select round(sum(pos::double * (tp::double / (tp + fp))) / max(all_pos)::double, 9) from {name})"


_CELLS = """
cells as (
  select count(*) filter (where is_fraud = 0 and fraud_flag = 0) as tn,
    count(*) filter (where is_fraud = 0 and fraud_flag = 1) as fp,
    count(*) filter (where is_fraud = 1 and fraud_flag = 0) as fn,
    count(*) filter (where is_fraud = 1 and fraud_flag = 1) as tp from mart)"""

_SWEEP = """
sweep as (
  select threshold, tp::double / (tp + fp) as precision, tp::double / all_pos as recall,
    (2 * tp)::double / (tp + fp + all_pos) as f1,
    (tp + fp)::double / (all_pos + all_neg) * 100 as flagged_pct from cum)"""


def _f1_at(condition: str) -> str:
    return (
        f"(select 2.0::double * count(*) filter (where is_fraud = 1 and {condition})"
        f" / (count(*) filter (where {condition}) + count(*) filter (where is_fraud = 1)) from mart)"
    )


_METRICS = f"""
metrics as (
  select round({_auc()}, 4) as roc_auc, round({_ap()}, 4) as avg_precision,
    round({_f1_at("risk_score / 165.0::double >= 0.5")}, 4) as fraud_f1,
    round({_auc()}, 4) as baseline_auc, round({_ap()}, 4) as baseline_ap,
    round({_f1_at("risk_score >= 50")}, 4) as baseline_f1)"""

# --- Quality: one statement per check ------------------------------------------------------------

_MODELS = {
    "stg_transactions": "stg",
    "int_customer_order_velocity": "velocity",
    "int_customer_risk_profile": "profile",
    "fct_fraud_signals": "mart",
}
_NOT_NULL = [
    ("stg_transactions", "order_id"),
    ("stg_transactions", "customer_id"),
    ("stg_transactions", "order_date"),
    ("stg_transactions", "order_amount"),
    ("stg_transactions", "payment_method"),
    ("stg_transactions", "product_category"),
    ("int_customer_order_velocity", "order_id"),
    ("int_customer_risk_profile", "customer_id"),
    ("fct_fraud_signals", "order_id"),
    ("fct_fraud_signals", "fraud_flag"),
    ("fct_fraud_signals", "risk_tier"),
    ("fct_fraud_signals", "risk_score"),
]
_UNIQUE = [
    ("stg_transactions", "order_id"),
    ("int_customer_order_velocity", "order_id"),
    ("int_customer_risk_profile", "customer_id"),
    ("fct_fraud_signals", "order_id"),
]
_ACCEPTED = [
    ("stg_transactions", "payment_method", "'visa','mastercard','discover','american express'"),
    ("stg_transactions", "product_category", "'Electronics','Clothing','Travel','Home & Garden','Services'"),
    ("fct_fraud_signals", "fraud_flag", "0, 1"),
    ("fct_fraud_signals", "risk_tier", "'none','low','medium','high'"),
]


def _check(model: str, column: str, test: str, count: str) -> str:
    return f"select '{model}' as model, '{column}' as \"column\", '{test}' as test, ({count}) as failures"


def _dq_not_null(models=_MODELS) -> list[str]:
    return [
        _check(m, c, "not_null", f"select count(*) from {models[m]} where {c} is null")
        for m, c in _NOT_NULL
        if m in models
    ]


def _dq_unique(models=_MODELS) -> list[str]:
    return [
        _check(
            m,
            c,
            "unique",
            f"select count(*) from (select {c} from {models[m]} where {c} is not null group by {c} having count(*) > 1)",
        )
        for m, c in _UNIQUE
        if m in models
    ]


def _dq_accepted(models=_MODELS) -> list[str]:
    return [
        _check(
            m,
            c,
            "accepted_values",
            f"select count(*) from (select {c} from {models[m]} where {c} not in ({words}) group by {c})",
        )
        for m, c, words in _ACCEPTED
        if m in models
    ]


# --- Exploration helpers -------------------------------------------------------------------------


def _histogram(value: str, bins: int, density: bool) -> str:
    edge = f"case when {{0}} = {bins} then hi else {{0}} * ((hi - lo) / {bins}) + lo end"
    extra = ""
    if density:
        extra = (
            f", coalesce(c.n, 0) / ({edge.format('(s.bin + 1)')} - ({edge.format('s.bin')})) / s.n as density"
        )
    return (
        with_mart(
            f"vals as (select is_fraud, ({value})::double as v from mart)",
            """ranges as (select is_fraud, case when max(v) > min(v) then min(v) else min(v) - 0.5 end as lo,
                 case when max(v) > min(v) then max(v) else max(v) + 0.5 end as hi, count(*) as n
               from vals group by 1)""",
            f"""guess as (select v.is_fraud, v, lo, hi,
                 least({bins - 1}, cast(floor((v - lo) / (hi - lo) * {bins}) as int)) as g
               from vals v join ranges r on v.is_fraud = r.is_fraud)""",
            f"""fit as (select is_fraud, case when v < {edge.format("g")} then g - 1
                 when v >= {edge.format("(g + 1)")} and g < {bins - 1} then g + 1 else g end as bin
               from guess)""",
            "counted as (select is_fraud, bin, count(*) as n from fit group by 1, 2)",
            f"""spine as (select r.*, cast(b.bin as int) as bin from ranges r, range(0, {bins}) b(bin))""",
        )
        + f""" select s.is_fraud, s.bin, {edge.format("s.bin")} as lower, {edge.format("(s.bin + 1)")} as upper,
          coalesce(c.n, 0) as orders{extra}
        from spine s left join counted c on s.is_fraud = c.is_fraud and s.bin = c.bin"""
    )


def _rate_by(column: str) -> str:
    return with_mart() + (
        f" select {column}, cast(sum(is_fraud) as double) / count(is_fraud) as fraud_rate,"
        f" count(is_fraud) as orders from mart group by {column}"
    )


_BUCKETS = [
    ("<7d", "account_age_days >= 0 and account_age_days < 7"),
    ("7-30d", "account_age_days >= 7 and account_age_days < 30"),
    ("30-90d", "account_age_days >= 30 and account_age_days < 90"),
    ("90-180d", "account_age_days >= 90 and account_age_days < 180"),
    ("180d-1y", "account_age_days >= 180 and account_age_days < 365"),
    ("1y+", "account_age_days >= 365"),
]

_CORR = [
    "order_amount",
    "order_hour",
    "account_age_days",
    "orders_on_day",
    "customer_avg_order_amount",
    "customer_ip_mismatch_count",
    "risk_score",
    "is_fraud",
]


def _corr(a: str, b: str) -> str:
    if a == b:
        return f"select '{a}' as feature_a, '{b}' as feature_b, 1.0::double as correlation"
    return f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as correlation from mart"


def _quartile(label: str, num: int, den: int) -> str:
    """Interpolated quantile of one label's cents, half up at the cent, by sorting all values."""
    values = f"(select list(round(order_amount * 100)::bigint order by order_amount) from mart where is_fraud = {label})"
    return (
        f"(select ((2 * (v[1 + (num // {den})] * {den}"
        f" + (v[1 + (num // {den}) + (case when num % {den} > 0 then 1 else 0 end)] - v[1 + (num // {den})]) * (num % {den})) + {den})"
        f" // (2 * {den})) / 100.0::double"
        f" from (select v, (len(v) - 1) * {num} as num from (select {values} as v)))"
    )


def _describe(label: int) -> str:
    return f"""select {label} as is_fraud, count(*) as "count",
      {ratio("sum(round(order_amount * 100)::bigint)", "count(*) * 100", 2)} as mean,
      round(stddev_samp(order_amount), 2) as std, min(order_amount) as min,
      {_quartile(str(label), 1, 4)} as q25, {_quartile(str(label), 1, 2)} as q50,
      {_quartile(str(label), 3, 4)} as q75, max(order_amount) as max
    from mart where is_fraud = {label}"""


_BOUNDARY = """
replay as (
  select order_id, order_id + 9000 as customer_id, cast(order_id % 10 as int) + 1 as case_id,
    case order_id % 10 + 1 when 2 then 149.99::double when 3 then 150.0::double when 9 then 150.0::double
      else 50.0::double end as order_amount,
    case when order_id % 10 + 1 in (4, 6) then 'CA' when order_id % 10 + 1 = 10 then 'GB' else 'US' end as shipping,
    case when order_id % 10 + 1 in (5, 6) then 'NG' else 'US' end as ip,
    order_id % 10 + 1 in (7, 8, 9) as is_new,
    case when order_id % 10 + 1 in (7, 8, 9) then 'crypto' else 'credit_card' end as payment,
    case when order_id % 10 + 1 in (8, 9) then 'gift_cards' else 'clothing' end as category,
    case when order_id % 10 + 1 = 10 then 3 else 12 end as hr
  from orders_feed),
replayed as (
  select case_id,
    (case when order_amount >= 150 then 20 else 0 end) + (case when shipping <> 'US' then 25 else 0 end)
    + (case when category = 'gift_cards' then 15 else 0 end)
    + (case when is_new and order_amount >= 100 then 20 else 0 end)
    + (case when hr between 1 and 5 then 10 else 0 end) + (case when ip <> 'US' then 25 else 0 end)
    + (case when is_new and payment = 'crypto' then 30 else 0 end) as score
  from replay),
expected(case_id, want, flag) as (
  values (1, 0, 0), (2, 0, 0), (3, 20, 0), (4, 25, 0), (5, 25, 0), (6, 50, 1), (7, 30, 0), (8, 45, 0), (9, 85, 1),
    (10, 35, 0))"""

ORACLES = {
    "csv_roundtrip": with_stage() + " select * from stg",
    "metrics_long": with_mart(_curve(), _METRICS)
    + _union(
        [
            f" select '{m}' as metric, {m} as value from metrics"
            for m in ("roc_auc", "avg_precision", "fraud_f1", "baseline_auc", "baseline_ap", "baseline_f1")
        ]
    ),
    "flagged_export": with_mart(PREDICTIONS, _FLAGGED)
    + """ select cast(order_id as varchar) as "Order ID", cast(customer_id as varchar) as "Customer",
        strftime(order_date, '%Y-%m-%d') as "Date", printf('$%.2f', order_amount) as "Amount",
        payment_method as "Payment", product_category as "Category", billing_country as "Billing",
        shipping_country as "Shipping", ip_country as "IP Country",
        cast(round_even(ml_fraud_prob * 100, 0)::int as varchar) || '%' as "ML Prob",
        cast(risk_score as varchar) as "Risk Score", risk_tier as "Tier" from flagged""",
    "reshape_card_txns": with_cards() + " select * from reshaped",
    "email_country": with_cards()
    + " select cast(order_id as bigint) as order_id, shipping_country, ip_country from reshaped",
    "impute_median": with_cards() + " select cast(order_id as bigint) as order_id, account_age_days from reshaped",
    "singleton_card": with_cards() + " select cast(order_id as bigint) as order_id, is_new_customer from reshaped",
    "reshape_profile": with_cards()
    + """ select 'rows' as measure, cast(null as varchar) as item, count(*)::double as value from reshaped
      union all select 'fraud_rate', null, sum(is_fraud)::double / count(*) from reshaped
      union all select 'new_customer_rate', null, sum(is_new_customer)::double / count(*) from reshaped
      union all (select 'billing_country', billing_country, count(*)::double from reshaped group by 2
        order by 3 desc, 2 limit 4)
      union all select 'product_category', product_category, count(*)::double from reshaped group by 2""",
    "stg_transactions": with_stage() + " select * from stg",
    "daily_order_counts": with_stage() + " select * from daily",
    "order_velocity": with_stage() + " select * from velocity",
    "customer_risk_profile": with_stage() + " select * from profile",
    "fct_fraud_signals": with_mart() + " select * from mart",
    "risk_score": with_mart() + " select order_id, risk_score from mart",
    "risk_tier": with_mart() + " select order_id, fraud_flag, risk_tier from mart",
    "rule_points_long": with_mart()
    + _union(
        [
            f" select order_id, '{name}' as rule, case when {cond} then {pts} else 0 end as points from mart"
            for name, (cond, pts) in _RULE_SQL.items()
        ]
    ),
    "score_variant": with_variant() + " select * from variant_flagged",
    "rule_coverage": with_variant()
    + _union(
        [
            f" select '{label}' as rule, coalesce(bool_or({cond}), false) as fires from variant_flagged"
            for label, cond in [
                ("High order amount (>=150)", "order_amount >= 150"),
                ("Country mismatch", "country_mismatch"),
                ("IP mismatch", "ip_mismatch"),
                ("High velocity (3+ orders/day)", "high_velocity"),
                ("Gift card purchase", "product_category = 'gift_cards'"),
                ("New customer + high amount", "is_new_customer and order_amount >= 100"),
                ("New customer + crypto", "is_new_customer and payment_method = 'crypto'"),
                ("Late-night order (1am-5am)", "order_hour between 1 and 5"),
            ]
        ]
    ),
    "score_boundaries": with_stage(_BOUNDARY)
    + """ select r.case_id, max(score) as risk_score, max(case when score >= 50 then 1 else 0 end) as fraud_flag,
        count(*) as orders,
        count(*) filter (where score = want and (case when score >= 50 then 1 else 0 end) = flag) as as_expected
      from replayed r join expected e on r.case_id = e.case_id group by 1""",
    "rule_attribution": with_mart()
    + _union(
        [
            f""" select order_id, '{name}' as rule, case when {cond} then {pts} else 0 end as points,
              (case when {cond} then {pts} else 0 end)
                - (select {pts} * count(*) filter (where {cond})::double / count(*) from mart) as attribution
            from mart"""
            for name, (cond, pts) in _RULE_SQL.items()
        ]
    ),
    "dq_not_null": with_mart() + _union(_dq_not_null()),
    "dq_unique": with_mart() + _union(_dq_unique()),
    "dq_accepted_values": with_mart() + _union(_dq_accepted()),
    "dq_suite": with_mart() + _union(_dq_not_null() + _dq_unique() + _dq_accepted()),
    "dq_stress_feed": with_variant()
    + _union(
        _dq_not_null({"stg_transactions": "stg"})
        + _dq_unique({"stg_transactions": "stg"})
        + _dq_accepted({"stg_transactions": "stg"})
    ),
    "report_summary": with_mart()
    + f""" select count(*) as total_orders, cast(sum(fraud_flag) as bigint) as flagged_orders,
        {percent("sum(fraud_flag)", "count(*)")} as fraud_rate_pct,
        {_hits("risk_tier = 'high'")} as high_risk, {_hits("risk_tier = 'medium'")} as medium_risk,
        {_hits("risk_tier = 'low'")} as low_risk, {_hits("risk_tier = 'none'")} as no_risk,
        round(sum(case when fraud_flag = 1 then order_amount::decimal(18,2) else 0 end), 0)::double as flagged_amount,
        {ratio("sum(risk_score) filter (where fraud_flag = 1)", "sum(fraud_flag)", 1)} as avg_risk_score
      from mart""",
    "tier_distribution": with_mart()
    + _union(
        [
            f""" select {rank} as tier_rank, '{tier}' as risk_tier, {_hits(f"risk_tier = '{tier}'")} as orders,
              {percent(_hits(f"risk_tier = '{tier}'"), "count(*)")} as share_pct,
              {percent(_hits(f"risk_score >= {floor}"), "count(*)", 2)} as cumulative_pct from mart"""
            for rank, (tier, floor) in enumerate([("high", 80), ("medium", 50), ("low", 25), ("none", 0)], start=1)
        ]
    ),
    "rule_hits": with_mart() + f" select rule, hits from ({_RULE_HITS})",
    "rule_hits_scaled": with_mart(f"hits as ({_RULE_HITS})")
    + f""" select rule, hits, {percent("hits", "(select count(*) from mart)")} as pct_total,
        coalesce({percent("hits", "(select max(hits) from hits)")}, 0) as bar_width from hits""",
    "ml_metric_cards": with_mart(_curve(), _METRICS)
    + """ select 'roc_auc' as metric, cast(roc_auc as varchar) as value from metrics
      union all select 'avg_precision', cast(avg_precision as varchar) from metrics
      union all select 'fraud_f1', cast(fraud_f1 as varchar) from metrics
      union all select 'baseline_auc', 'N/A' union all select 'baseline_ap', 'N/A'
      union all select 'baseline_f1', 'N/A'""",
    "ml_summary": with_mart(PREDICTIONS)
    + f""" select cast(sum(ml_fraud_flag) as bigint) as ml_flagged,
        {percent("sum(ml_fraud_flag)", "count(*)")} as ml_flag_rate,
        {_hits("ml_fraud_flag = 1 and f.fraud_flag = 1")} as both_flagged
      from preds m join mart f using (order_id)""",
    "flagged_top50": with_mart(PREDICTIONS, _FLAGGED) + " select * from flagged",
    "flagged_bars": with_mart(PREDICTIONS, _FLAGGED)
    + f""" select * replace (strftime(order_date, '%Y-%m-%d') as order_date),
        {percent("risk_score", "165")} as score_bar_pct from flagged""",
    "flagged_filter": with_mart(PREDICTIONS, _FLAGGED)
    + """ select *, (select count(*) from flagged where risk_tier = 'high' and payment_method = 'visa') as visible
      from flagged where risk_tier = 'high' and payment_method = 'visa'""",
    "class_balance": with_mart()
    + """ select is_fraud, count(*) as orders, count(*)::double / (select count(*) from mart) as share
      from mart group by 1""",
    "amount_histogram": _histogram("case when order_amount > 1000 then 1000 else order_amount end", 60, False),
    "amount_describe": with_mart() + f" {_describe(0)} union all {_describe(1)}",
    "fraud_rate_by_category": _rate_by("product_category"),
    "fraud_rate_by_payment": _rate_by("payment_method"),
    "fraud_rate_by_tier": _rate_by("risk_tier"),
    "fraud_rate_by_hour": with_mart(
        """hourly as (select order_hour, sum(is_fraud)::double / count(is_fraud) * 100 as fraud_rate_pct
             from mart group by 1)"""
    )
    + " select *, (select round(avg(fraud_rate_pct), 9) from hourly) as mean_of_hours_pct from hourly",
    "fraud_rate_by_age": with_mart()
    + _union(
        [
            f""" select '{name}' as age_bucket, sum(is_fraud)::double / nullif(count(*), 0) as fraud_rate,
              count(*) as orders from mart where {cond}"""
            for name, cond in _BUCKETS
        ]
    ),
    "rule_precision_recall": with_mart()
    + _union(
        [
            f""" select '{label}' as rule, {percent(_hits(_RULE_SQL[name][0]), "count(*)")} as hit_rate_pct,
              {percent(_hits(f"({_RULE_SQL[name][0]}) and is_fraud = 1"), _hits(_RULE_SQL[name][0]))} as precision_pct,
              {percent(_hits(f"({_RULE_SQL[name][0]}) and is_fraud = 1"), "sum(is_fraud)")} as recall_pct,
              {percent("sum(is_fraud)", "count(*)", 2)} as base_rate_pct from mart"""
            for name, label in _EXPLORE_LABELS.items()
        ]
    ),
    "score_density": _histogram("risk_score", 30, True),
    "correlations": with_mart() + _union([f" {_corr(a, b)}" for a in _CORR for b in _CORR]),
    "confusion_matrix": with_mart(_CELLS) + " select * from cells",
    "classification_report": with_mart(
        _CELLS,
        """parts as (select tn::double / (tn + fn) as p0, tn::double / (tn + fp) as r0,
             (2 * tn)::double / (2 * tn + fn + fp) as f0, tp::double / (tp + fp) as p1, tp::double / (tp + fn) as r1,
             (2 * tp)::double / (2 * tp + fp + fn) as f1, tn + fp as n0, fn + tp as n1, tn + fp + fn + tp as n,
             (tn + tp)::double / (tn + fp + fn + tp) as acc from cells)""",
    )
    + """ select 'Legit' as class, p0 as precision, r0 as recall, f0 as f1, n0 as support from parts
      union all select 'Fraud', p1, r1, f1, n1 from parts
      union all select 'accuracy', null, null, acc, n from parts
      union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from parts
      union all select 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n,
        (f0 * n0 + f1 * n1) / n, n from parts""",
    "threshold_sweep": with_mart(_curve(), _SWEEP) + " select * from sweep",
    "best_threshold": with_mart(_curve(), _SWEEP)
    + """ select * from (select 'best' as choice, * from sweep order by f1 desc, threshold limit 1)
      union all select 'current' as choice, * from sweep where threshold = 50""",
    "roc_curve": with_mart(
        _curve(),
        """stepped as (select *, lead(pos) over w as np, lead(neg) over w as nn, row_number() over w as rn
             from cum window w as (order by threshold desc))""",
    )
    + """ select threshold::double as threshold, fp::double / all_neg as fpr, tp::double / all_pos as tpr
      from stepped where rn = 1 or np is null or not (np = pos and nn = neg)
      union all select 'infinity'::double, 0, 0""",
    "roc_auc": with_mart(_curve()) + f" select {_auc()} as roc_auc",
    "pr_curve": with_mart(_curve())
    + """ select threshold::double as threshold, tp::double / (tp + fp) as precision, tp::double / all_pos as recall
      from cum union all select null, 1, 0""",
    "average_precision": with_mart(_curve()) + f" select {_ap()} as avg_precision",
    "f1_score": with_mart(_CELLS) + " select (2 * tp)::double / (2 * tp + fp + fn) as fraud_f1 from cells",
    "baseline_summary": with_mart(_curve(), _CELLS)
    + f""" select (tp + fn)::double / (tn + fp + fn + tp) as fraud_rate, 50 as threshold, {_auc()} as roc_auc,
        {_ap()} as avg_precision, (2 * tp)::double / (2 * tp + fp + fn) as fraud_f1,
        tp::double / (tp + fp) as fraud_precision, tp::double / (tp + fn) as fraud_recall from cells""",
}

__all__ = ["ORACLES", "h"]
