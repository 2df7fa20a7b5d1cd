"""Seeded faults, their ground truth, and simulated shipping days."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.operators import faults, shipping
from strataline.workloads.feeds import LOAD_TS
from strataline.workloads.registry import case, portable

SEED = 7

CLEAN = {
    "product": """SELECT p_partkey AS id, p_name AS title, p_type AS category,
                         concat('SKU-', CAST(p_partkey AS STRING), '-', p_brand) AS pkey
                  FROM {part}""",
    "user": """SELECT s_suppkey AS id, s_name AS first_name, n_name AS last_name,
                      CASE s_suppkey % 2 WHEN 0 THEN 'male' ELSE 'female' END AS gender
               FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "order": """SELECT event_id AS id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS prd_id,
                       user_id AS cust_id, value AS unit_price, event_id % 5 + 1 AS quantity,
                       value * (event_id % 5 + 1) AS total_price
                FROM {events}""",
}
KEYS = {
    "product": "CAST(id AS VARCHAR)",
    "user": "CAST(id AS VARCHAR)",
    "order": "CAST(id AS VARCHAR) || '_' || CAST(prd_id AS VARCHAR)",
}
COLUMNS = {
    "product": ("id", "title", "category", "pkey"),
    "user": ("id", "first_name", "last_name", "gender"),
    "order": ("id", "prd_id", "cust_id", "unit_price", "quantity", "total_price"),
}


def draw(key: str, *salt: object) -> str:
    parts = ", ".join([key, *[f"'{s}'" for s in salt]])
    return f"(CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 8) AS BIGINT) / 4294967296.0)"


def between(key: str, low: int, high: int, *salt: object) -> str:
    return f"CAST(floor({draw(key, *salt)} * {high - low + 1}) + {low} AS INTEGER)"


def damaged(field: str, kind: str, key: str) -> str:
    pick = draw(key, field, SEED, "strategy")
    if kind == "price":
        return (
            f"CASE WHEN {pick} < 0.70 THEN {field} WHEN {pick} < 0.83 THEN {field} * 0.5 "
            f"WHEN {pick} < 0.96 THEN {field} * 1.5 WHEN {pick} < 0.98 THEN {field} * 3.0 END"
        )
    text = f"CAST({field} AS VARCHAR)"
    if kind == "id":
        way = between(key, 0, 3, field, SEED, "strategy")
        padded = f"CASE WHEN length({text}) >= 4 THEN {text} ELSE lpad({text}, 4, '0') END"
        return (
            f"CASE {way} WHEN 0 THEN 'dummy-' || {text} WHEN 1 THEN {padded} "
            f"WHEN 2 THEN ' ' || {text} || ' ' ELSE {text} END"
        )
    if kind == "key":
        way = between(key, 0, 2, field, SEED, "strategy")
        suffix = between(key, 10, 99, field, SEED, "suffix")
        return (
            f"CASE {way} WHEN 0 THEN replace({text}, '-', '_') WHEN 1 THEN lower({text}) "
            f"ELSE {text} || '-' || CAST({suffix} AS VARCHAR) END"
        )
    blanks = f"repeat(' ', {between(key, 1, 4, field, SEED, 'blanks')})"
    return (
        f"CASE WHEN {pick} < 0.24 THEN upper({text}) WHEN {pick} < 0.48 THEN lower({text}) "
        f"WHEN {pick} < 0.72 THEN {blanks} || {text} WHEN {pick} < 0.96 THEN {text} || {blanks} END"
    )


def after(field: str, key: str) -> str:
    kind = faults.FIELD_FAULTS[field]
    clean = field if kind == "price" else f"CAST({field} AS VARCHAR)"
    hit = f"{draw(key, field, SEED, 'hit')} < {faults.DEFAULT_RATE}"
    return f"CASE WHEN {hit} THEN {damaged(field, kind, key)} ELSE {clean} END"


def _source(data_type: str) -> str:
    return CLEAN[data_type].replace("{", "").replace("}", "")


def _clean(t, data_type: str):
    return t.feed(CLEAN[data_type])


def _faults_case(data_type: str) -> None:
    key = KEYS[data_type]
    shown = ", ".join(
        f"{after(c, key)} AS {c}" if c in faults.FIELD_FAULTS else c for c in COLUMNS[data_type]
    )

    @case(f"fi1_inject_{data_type}_faults", f"SELECT {shown} FROM ({_source(data_type)}) AS clean")
    def build(t):
        clean = _clean(t, data_type)
        return faults.inject_faults(clean, faults.record_key(data_type), seed=SEED)

    truths = " UNION ALL ".join(
        f"SELECT '{data_type}' AS data_type, {key} AS record_id, '{c}' AS field_name, "
        f"'{faults.FIELD_FAULTS[c]}' AS corruption_type, "
        f"({c if faults.FIELD_FAULTS[c] == 'price' else f'CAST({c} AS VARCHAR)'}) IS DISTINCT FROM "
        f"({after(c, key)}) AS is_corrupted, '{LOAD_TS}' AS ingestion_run_at "
        f"FROM ({_source(data_type)}) AS clean"
        for c in COLUMNS[data_type]
        if c in faults.FIELD_FAULTS
    )

    @case(f"fi7_{data_type}_ground_truth", truths)
    def build_truth(t):
        return faults.ground_truth(_clean(t, data_type), data_type, LOAD_TS, seed=SEED)


for _data_type in CLEAN:
    _faults_case(_data_type)


# Each kind of damage on every row of a column, and which strategies it took

DAMAGED = {
    "fi2_damage_ids": ("order", "cust_id"),
    "fi3_damage_texts": ("user", "last_name"),
    "fi4_damage_keys": ("product", "pkey"),
    "fi5_damage_prices": ("order", "total_price"),
}
_BUILDERS = {
    "id": faults.damage_id,
    "string": faults.damage_text,
    "key": faults.damage_key,
    "price": faults.damage_price,
}


def _damage_case(name: str, data_type: str, field: str) -> None:
    kind, key = faults.FIELD_FAULTS[field], KEYS[data_type]

    @case(
        name,
        f"SELECT {key} AS record_id, {damaged(field, kind, key)} AS damaged "
        f"FROM ({_source(data_type)}) AS clean",
    )
    def build(t):
        key_column = faults.record_key(data_type)
        return _clean(t, data_type).select(
            key_column.alias("record_id"),
            _BUILDERS[kind](F.col(field), key_column, field, SEED).alias("damaged"),
        )


for _name, (_kind, _field) in DAMAGED.items():
    _damage_case(_name, _kind, _field)


_DAY = "min(CAST(try_strptime(sls_order_dt, '%Y%m%d') AS DATE))"


def _delay() -> str:
    key, season = "sls_ord_num", "(month(day) % 12 + 3) // 3"
    usual = " ".join(
        f"WHEN {n} THEN {between(key, s.shortest, s.longest, SEED, 'days')}"
        for n, s in shipping.SEASONS.items()
    )
    extra = " ".join(
        f"WHEN {n} THEN {between(key, 1, s.longest // s.extra_divisor, SEED, 'extra')}"
        for n, s in shipping.SEASONS.items()
    )
    outlier = f"month(day) IN (1, 4, 7, 10) AND {draw(key, SEED, 'outlier')} < 0.05"
    same_day = f"{draw(key, SEED, 'same-day')} < 0.70"
    return (
        f"CASE WHEN {outlier} AND {same_day} THEN 0 WHEN {outlier} THEN "
        f"CASE {season} {usual} END + CASE {season} {extra} END ELSE CASE {season} {usual} END END"
    )


@case(
    "fi8_order_shipments",
    f"""SELECT sls_ord_num, CAST(day AS VARCHAR) AS order_day,
               CAST(day + {_delay()} AS VARCHAR) AS ship_day
        FROM (SELECT sls_ord_num, {_DAY} AS day FROM crm_sales_details
              WHERE length(sls_order_dt) = 8 GROUP BY sls_ord_num) AS ordered
        WHERE day IS NOT NULL""",
    "bronze",
)
def fi8(t):
    shipments = shipping.order_shipments(
        t.bronze["crm_sales_details"], "sls_ord_num", "sls_order_dt", SEED
    )
    return portable(shipments)


@case(
    "fi8_override_ship_dates",
    f"""SELECT s.sls_ord_num, s.sls_prd_key, s.sls_order_dt,
               coalesce(strftime(day + {_delay().replace("sls_ord_num", "s.sls_ord_num")}, '%Y%m%d'),
                        s.sls_ship_dt) AS sls_ship_dt
        FROM crm_sales_details AS s LEFT JOIN
             (SELECT sls_ord_num AS order_no, {_DAY} AS day FROM crm_sales_details
              WHERE length(sls_order_dt) = 8 GROUP BY sls_ord_num) AS ordered
               ON s.sls_ord_num = order_no""",
    "bronze",
)
def fi8_override(t):
    changed = shipping.override_ship_dates(
        t.bronze["crm_sales_details"], "sls_ord_num", "sls_order_dt", "sls_ship_dt", SEED
    )
    return changed.select("sls_ord_num", "sls_prd_key", "sls_order_dt", "sls_ship_dt")


@case(
    "fi9_unusable_order_dates",
    """SELECT sls_order_dt, count(*) AS row_count FROM crm_sales_details
       WHERE length(sls_order_dt) <> 8 OR sls_order_dt IS NULL
          OR try_strptime(sls_order_dt, '%Y%m%d') IS NULL GROUP BY sls_order_dt""",
    "bronze",
)
def fi9(t):
    """Order dates the simulation cannot use; their lines keep the stated shipping day."""
    bad = t.bronze["crm_sales_details"].filter(shipping.dates.compact_day("sls_order_dt").isNull())
    return bad.groupBy("sls_order_dt").agg(F.count(F.lit(1)).alias("row_count"))
