"""For each registered query, the same result in SQL over the sample tables, written independently."""

from __future__ import annotations

# The extracts, as in voltmark_checks.sample_lake.
EXTRACTS = {
    "raw_site": """
        SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey::varchar END AS site_id,
               c_name AS site_name, n_name AS country,
               CASE WHEN c_acctbal BETWEEN 0 AND 200 THEN NULL
                    ELSE CASE r_name WHEN 'EUROPE' THEN 'EMEA' WHEN 'AMERICA' THEN 'AMER'
                                     WHEN 'ASIA' THEN 'APAC' ELSE r_name END END AS region,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown'
                    ELSE (n_nationkey * 2.5::double)::varchar END AS latitude,
               (n_nationkey * -7.25::double)::varchar AS longitude,
               CASE WHEN again THEN lower(c_mktsegment) ELSE c_mktsegment END AS site_type, c_acctbal::varchar AS contracted_power_kw,
               '2020-' || lpad((1 + n_nationkey % 12)::varchar, 2, '0') || '-' || (31 - n_nationkey % 3)::varchar
                   AS commissioned_date, ingested_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
             CROSS JOIN (VALUES (TIMESTAMP '2024-02-01 00:00:00', false), (TIMESTAMP '2024-02-03 00:00:00', true))
                        d(ingested_at, again)
        WHERE NOT again OR c_nationkey % 5 = 0""",
    "raw_device": """
        SELECT CASE WHEN p_size > 2 THEN p_partkey::varchar END AS device_id,
               (p_partkey // 4)::varchar AS site_id, p_type AS device_type,
               CASE WHEN again THEN 'A-' ELSE '' END || p_brand AS model,
               CASE WHEN p_type = 'SMALL' THEN 'A' ELSE 'kWh' END AS measurement_unit,
               'feeder-' || p_size::varchar AS install_location,
               CASE WHEN p_size < 10 THEN 'true' WHEN p_size < 20 THEN 'TRUE' WHEN p_size < 30 THEN 'False'
                    WHEN p_size < 40 THEN ' true ' WHEN p_size < 45 THEN 'yes' END AS is_active, ingested_at
        FROM part, (VALUES (TIMESTAMP '2024-02-01 00:00:00', false), (TIMESTAMP '2024-02-03 00:00:00', true))
                   d(ingested_at, again)
        WHERE NOT again OR p_size % 7 = 0""",
    "raw_meter_readings": """
        SELECT CASE WHEN event_type = 'signup' AND value > 60 THEN NULL ELSE event_id::varchar END AS reading_id,
               user_id::varchar AS device_id,
               CASE WHEN event_type = 'view' AND value < 2 THEN NULL ELSE (user_id // 4)::varchar END AS site_id,
               CASE WHEN event_type = damaged AND value < 5 THEN 'x'
                    WHEN event_type = 'purchase' AND value < 3 THEN '08:00:00'
                    WHEN event_type = 'purchase' AND value < 4 THEN 'T08:00' ELSE ts::varchar END AS "timestamp",
               CASE WHEN event_type = 'signup' AND value < 5 THEN 'n/a'
                    ELSE (round(value * 100) * 0.5::double)::varchar END AS active_power_kw,
               CASE WHEN event_type = 'view' AND value > 60 THEN 'abc'
                    ELSE (round(value * 100) * 0.25::double + extra)::varchar END AS energy_kwh,
               (200 + user_id * 0.125::double)::varchar AS voltage_v,
               (round(value * 100) * 0.125::double)::varchar AS current_a,
               CASE event_type WHEN 'purchase' THEN '0.875' WHEN 'click' THEN '0.9375'
                               WHEN 'view' THEN '0.96875' ELSE '1.0' END AS power_factor,
               ingested_at
        FROM events, (VALUES ('error', 0, TIMESTAMP '2024-02-01 00:00:00', false),
                             ('click', 1, TIMESTAMP '2024-02-02 00:00:00', true)) d(damaged, extra, ingested_at, again)
        WHERE NOT again OR event_type IN ('click', 'error')""",
    "raw_billing": """
        SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 10000 THEN NULL
                    ELSE o_orderkey::varchar END AS cost_id,
               CASE WHEN o_orderpriority = '3-MEDIUM' AND o_totalprice < 5000 THEN NULL
                    ELSE o_custkey::varchar END AS site_id,
               strftime(o_orderdate, '%Y-%m') AS billing_period,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 20000 THEN ''
                    ELSE (round(o_totalprice * 100) * 0.125::double)::varchar END AS energy_consumed_kwh,
               (round(o_totalprice * 100)::bigint % 1000 * 0.5::double)::varchar AS peak_demand_kw,
               '0.125' AS tariff_rate,
               (round(o_totalprice * 100) * 0.25::double + extra)::varchar AS energy_cost,
               (round(o_totalprice * 100) * 0.0625::double)::varchar AS co2_emissions_kg,
               CASE WHEN o_orderstatus = 'F' THEN 'EUR' ELSE 'USD' END AS currency, ingested_at
        FROM orders, (VALUES (0, TIMESTAMP '2024-02-01 00:00:00'), (3, TIMESTAMP '2024-02-04 00:00:00'))
                     d(extra, ingested_at)
        WHERE extra = 0 OR o_orderkey % 10 = 0""",
    "supplier_source": """
        SELECT s_suppkey::varchar AS supplier_id, s_name AS supplier_name,
               CASE WHEN s_acctbal < 1000 THEN 'Distributor' WHEN s_acctbal < 6000 THEN 'Service Partner'
                    ELSE 'OEM' END AS supplier_type,
               n_name AS country,
               contract_year || '-' || lpad((1 + n_nationkey % 12)::varchar, 2, '0') || '-' || (31 - n_nationkey % 3)::varchar
                   AS contract_since, ingested_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
             CROSS JOIN (VALUES ('2021', TIMESTAMP '2024-02-01 00:00:00'), ('2020', TIMESTAMP '2024-02-05 00:00:00'))
                        d(contract_year, ingested_at)
        WHERE contract_year = '2021' OR s_suppkey % 3 = 0""",
    "maintenance_source": """
        SELECT l_orderkey::varchar || '-' || l_linenumber::varchar AS event_id,
               l_partkey::varchar AS device_id, (l_partkey // 4)::varchar AS site_id,
               CASE WHEN l_discount > 0 THEN l_suppkey::varchar END AS supplier_id,
               l_shipdate - to_days(back) AS event_date,
               CASE l_returnflag WHEN 'R' THEN 'repair' WHEN 'A' THEN 'inspection' ELSE 'replacement' END AS event_type,
               l_quantity * 0.5::double AS downtime_hours,
               round(l_extendedprice * 100) * 0.25::double AS cost,
               CASE WHEN l_linestatus = 'O' THEN 'EUR' ELSE 'USD' END AS currency,
               'order ' || l_orderkey::varchar || ' line ' || l_linenumber::varchar AS description, ingested_at
        FROM lineitem, (VALUES (0, TIMESTAMP '2024-02-01 00:00:00'), (30, TIMESTAMP '2024-02-05 00:00:00')) d(back, ingested_at)
        WHERE back = 0 OR l_partkey % 9 = 0""",
}

_D = "try_cast({0} AS double) AS {0}".format


def _first(columns: str, source: str, key: str, latest: str, ties: str) -> str:
    """One row per key: highest ``latest`` first, then all other columns ascending."""
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ties.split())
    front = f"{latest} DESC NULLS LAST, " if latest else ""
    return f"""
        SELECT {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {front}{order}) AS rn FROM ({source})
        ) WHERE rn = 1"""


_READINGS = f"""
    SELECT reading_id, device_id, site_id, try_cast("timestamp" AS timestamp) AS "timestamp",
           {_D('active_power_kw')}, {_D('energy_kwh')}, {_D('voltage_v')}, {_D('current_a')}, {_D('power_factor')},
           ingested_at
    FROM raw_meter_readings"""

_READING_COLUMNS = (
    'reading_id, device_id, site_id, "timestamp", active_power_kw, energy_kwh, voltage_v, current_a, power_factor, '
    'CAST("timestamp" AS date) AS reading_date'
)


def _consumption(where: str = "") -> str:
    return _first(
        _READING_COLUMNS,
        f"""SELECT * FROM ({_READINGS}) WHERE reading_id IS NOT NULL AND "timestamp" IS NOT NULL {where}""",
        "reading_id",
        "ingested_at",
        'device_id site_id "timestamp" active_power_kw energy_kwh voltage_v current_a power_factor',
    )


_LAST_SITES = _first(
    "*",
    "SELECT * FROM raw_site WHERE site_id IS NOT NULL",
    "site_id",
    "ingested_at",
    "site_name country region latitude longitude site_type contracted_power_kw commissioned_date",
)


def _sites(consumption: str) -> str:
    return f"""
        SELECT s.site_id, site_name, country, region, md5(region) AS region_id,
               try_cast(latitude AS double) AS latitude, try_cast(longitude AS double) AS longitude, site_type,
               try_cast(contracted_power_kw AS double) AS contracted_power_kw,
               try_cast(commissioned_date AS date) AS commissioned_date,
               coalesce(e.kwh, 0) AS total_energy_kwh, coalesce(c.cost, 0) AS total_energy_cost,
               coalesce(c.co2, 0) AS total_co2_kg
        FROM ({_LAST_SITES}) s
        LEFT JOIN (SELECT site_id, sum(energy_kwh) AS kwh FROM {consumption} GROUP BY site_id) e
               ON e.site_id = s.site_id
        LEFT JOIN (SELECT site_id, sum(energy_cost) AS cost, sum(co2_emissions_kg) AS co2
                   FROM fact_energy_cost GROUP BY site_id) c ON c.site_id = s.site_id"""


SILVER = {
    "dim_region": """
        SELECT DISTINCT md5(region) AS region_id, region AS region_code,
               CASE region WHEN 'EMEA' THEN 'Europe, Middle East & Africa' WHEN 'AMER' THEN 'Americas'
                           WHEN 'APAC' THEN 'Asia-Pacific' ELSE region END AS region_name
        FROM raw_site WHERE region IS NOT NULL""",
    "dim_device": _first(
        "device_id, site_id, device_type, model, measurement_unit, install_location, lower(is_active) = 'true' AS is_active",
        "SELECT * FROM raw_device WHERE device_id IS NOT NULL",
        "device_id",
        "ingested_at",
        "site_id device_type model measurement_unit install_location is_active",
    ),
    "fact_energy_consumption": _consumption(),
    "fact_energy_cost": _first(
        f"cost_id, site_id, billing_period, {_D('energy_consumed_kwh')}, {_D('peak_demand_kw')}, "
        f"{_D('tariff_rate')}, {_D('energy_cost')}, {_D('co2_emissions_kg')}, currency",
        "SELECT * FROM raw_billing WHERE cost_id IS NOT NULL",
        "cost_id",
        "ingested_at",
        "site_id billing_period energy_consumed_kwh peak_demand_kw tariff_rate energy_cost co2_emissions_kg currency",
    ),
    "dim_site": _sites("fact_energy_consumption"),
    "dim_supplier": _first(
        "supplier_id, supplier_name, supplier_type, country, try_cast(contract_since AS date) AS contract_since",
        "SELECT * FROM supplier_source WHERE supplier_id IS NOT NULL",
        "supplier_id",
        "ingested_at DESC NULLS LAST, try_cast(contract_since AS date)",
        "supplier_name supplier_type country",
    ),
    "maintenance_event": _first(
        "event_id, device_id, site_id, supplier_id, event_date, event_type, downtime_hours, cost, currency, description",
        "SELECT * FROM maintenance_source WHERE event_id IS NOT NULL",
        "event_id",
        "ingested_at DESC NULLS LAST, event_date",
        "device_id site_id supplier_id event_type downtime_hours cost currency description",
    ),
}

_ORDER = [
    *EXTRACTS,
    "dim_region",
    "dim_device",
    "fact_energy_consumption",
    "fact_energy_cost",
    "dim_site",
    "dim_supplier",
    "maintenance_event",
]


def _sql(select: str, **more: str) -> str:
    """``select`` with the extracts and silver tables it may name as common table expressions."""
    tables = {name: (EXTRACTS | SILVER)[name] for name in _ORDER} | more
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in tables.items()) + "\n" + select


def _date(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


_CONSUMPTION_TEXT = f"""reading_id, device_id, site_id, {_time('"timestamp"')}, active_power_kw, energy_kwh,
    voltage_v, current_a, power_factor, {_date('reading_date')}"""

_SITE_TEXT = (
    "site_id, site_name, country, region, region_id, latitude, longitude, site_type, contracted_power_kw, "
    f"{_date('commissioned_date')}, total_energy_kwh, total_energy_cost, total_co2_kg"
)

_DAILY = """
    SELECT site_id, day AS reading_date, sum(energy_kwh) AS total_energy_kwh,
           sum(active_power_kw) / count(active_power_kw) AS avg_active_power_kw,
           sum(power_factor) / count(power_factor) AS avg_power_factor, count(*) AS reading_count
    FROM (SELECT *, strftime(reading_date, '%Y-%m-%d') AS day FROM fact_energy_consumption) GROUP BY site_id, day"""


def _kpi(extra: str = "") -> str:
    return f"""
    SELECT region_id, region, billing_period{extra}, sum(co2_emissions_kg) AS total_co2_kg,
           sum(energy_consumed_kwh) AS total_energy_kwh, sum(energy_cost) AS total_cost
    FROM fact_energy_cost LEFT JOIN dim_site USING (site_id) GROUP BY region_id, region, billing_period{extra}"""


# Facts and sites with every dimension column a slicer may ask for; no match gives nulls.
_STAR = {
    "site_star": "SELECT s.*, r.region_name FROM dim_site s LEFT JOIN dim_region r USING (region_id)",
    "energy_star": """SELECT f.energy_kwh, f.power_factor, s.country, s.site_name, s.site_type, s.region_name,
                             d.device_type, d.site_id AS device_site
                      FROM fact_energy_consumption f LEFT JOIN site_star s USING (site_id)
                           LEFT JOIN dim_device d USING (device_id)""",
    "cost_star": """SELECT f.*, s.country, s.site_name, s.site_type, s.region_name
                    FROM fact_energy_cost f LEFT JOIN site_star s USING (site_id)""",
}

_PARTS = {
    "energy": "sum(energy_kwh) AS total_energy, sum(power_factor) / nullif(count(power_factor), 0) AS avg_power_factor",
    "cost": "sum(energy_cost) AS total_energy_cost, sum(co2_emissions_kg) AS total_co2",
    "site": "count(*) AS site_count",
}


def _measured(by: str, columns: str, where: str = "true") -> str:
    """All measures per group: each fact summed alone, then joined on the groups, nulls matching."""
    keys = by.split()
    listed = ", ".join(keys)
    selects = {
        star: f"SELECT {listed}, {aggregates} FROM {star}_star WHERE {where} GROUP BY {listed}"
        for star, aggregates in _PARTS.items()
    }

    def on(left: str, right: str) -> str:
        return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys)

    groups = " UNION ".join(f"SELECT {listed} FROM ({s})" for s in selects.values())
    ratio = (
        "total_energy_cost / nullif(total_energy, 0) AS cost_per_kwh, "
        "total_co2 / nullif(total_energy, 0) AS co2_intensity"
    )
    full = f"""SELECT g.*, e.* EXCLUDE ({listed}), c.* EXCLUDE ({listed}), s.* EXCLUDE ({listed}), {ratio}
        FROM ({groups}) g LEFT JOIN ({selects['energy']}) e ON {on('g', 'e')}
             LEFT JOIN ({selects['cost']}) c ON {on('g', 'c')} LEFT JOIN ({selects['site']}) s ON {on('g', 's')}"""
    asked = columns.split()
    some = " OR ".join(f"{c} IS NOT NULL" for c in asked)
    return _sql(f"SELECT {listed}, {', '.join(asked)} FROM ({full}) WHERE {some}", **_STAR)


_ALL = "total_energy_cost total_co2 cost_per_kwh co2_intensity total_energy avg_power_factor site_count"

_UUID_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
_PROPERTIES = {
    "entity_region": "SELECT region_id, region_code, region_name, region_name AS display_name FROM dim_region",
    "entity_site": """SELECT site_id, site_name, country, region_id, site_type, contracted_power_kw, total_energy_kwh,
                             total_energy_cost, total_co2_kg, site_name AS display_name FROM dim_site""",
    "entity_device": """SELECT device_id, site_id, device_type, model, measurement_unit, is_active,
                               device_id AS display_name FROM dim_device""",
    "entity_energy_reading": """SELECT reading_id, device_id, site_id,
                                strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS "timestamp", energy_kwh,
                                active_power_kw, power_factor, reading_id AS display_name
                                FROM fact_energy_consumption""",
    "entity_billing_record": """SELECT cost_id, site_id, billing_period, energy_cost, co2_emissions_kg, currency,
                                       cost_id AS display_name FROM fact_energy_cost""",
    "entity_supplier": """SELECT supplier_id, supplier_name, supplier_type, country, supplier_name AS display_name
                          FROM dim_supplier""",
    "entity_maintenance_event": f"""SELECT event_id, device_id, site_id, supplier_id, {_time('event_date')}, event_type,
                                    downtime_hours, cost, description, description AS display_name
                                    FROM maintenance_event""",
}

# Every device with the region it stands in, if any.
_NODES = """
        SELECT 'Region' AS type, region_id AS id, region_name AS display_name FROM dim_region
        UNION ALL SELECT 'Site', site_id, site_name FROM dim_site
        UNION ALL SELECT 'Device', device_id, device_id FROM dim_device
        UNION ALL SELECT 'EnergyReading', reading_id, reading_id FROM fact_energy_consumption
        UNION ALL SELECT 'BillingRecord', cost_id, cost_id FROM fact_energy_cost
        UNION ALL SELECT 'Supplier', supplier_id, supplier_name FROM dim_supplier
        UNION ALL SELECT 'MaintenanceEvent', event_id, description FROM maintenance_event"""
_EDGES = """
        SELECT DISTINCT * FROM (
            SELECT 'locatedIn' AS rel, 'Site' AS src_type, site_id AS src, 'Region' AS dst_type, region_id AS dst FROM dim_site
            UNION ALL SELECT 'hasDevice', 'Site', site_id, 'Device', device_id FROM dim_device
            UNION ALL SELECT 'produces', 'Device', device_id, 'EnergyReading', reading_id FROM fact_energy_consumption
            UNION ALL SELECT 'billedFor', 'Site', site_id, 'BillingRecord', cost_id FROM fact_energy_cost
            UNION ALL SELECT 'hasMaintenance', 'Device', device_id, 'MaintenanceEvent', event_id FROM maintenance_event
            UNION ALL SELECT 'performedBy', 'MaintenanceEvent', event_id, 'Supplier', supplier_id FROM maintenance_event)
        WHERE src IS NOT NULL AND dst IS NOT NULL"""
_DEVICE_REGION = """SELECT d.device_id, region_name FROM dim_device d
                    LEFT JOIN dim_site s ON s.site_id = d.site_id LEFT JOIN dim_region USING (region_id)"""

# Energy reaches both slicers; CO2 and site count only the second, over whose groups they repeat. A member
# that only they have is a row without a device type.
_PARTLY = """
    SELECT g.device_type, g.{column}, e.total_energy, c.total_co2, s.site_count
    FROM (SELECT DISTINCT device_type, {column} FROM energy_star
          UNION ALL
          SELECT NULL, {column} FROM (SELECT {column} FROM cost_star UNION SELECT {column} FROM site_star) m
          WHERE NOT EXISTS (SELECT 1 FROM energy_star x WHERE x.{column} IS NOT DISTINCT FROM m.{column})) g
    LEFT JOIN (SELECT device_type, {column}, sum(energy_kwh) AS total_energy FROM energy_star GROUP BY ALL) e
           ON e.device_type IS NOT DISTINCT FROM g.device_type AND e.{column} IS NOT DISTINCT FROM g.{column}
    LEFT JOIN (SELECT {column}, sum(co2_emissions_kg) AS total_co2 FROM cost_star GROUP BY ALL) c
           ON c.{column} IS NOT DISTINCT FROM g.{column}
    LEFT JOIN (SELECT {column}, count(*) AS site_count FROM site_star GROUP BY ALL) s
           ON s.{column} IS NOT DISTINCT FROM g.{column}
    WHERE total_energy IS NOT NULL OR total_co2 IS NOT NULL OR site_count IS NOT NULL"""

_EVENT_WALK = """
    FROM dim_site s JOIN dim_device d ON d.site_id = s.site_id
         JOIN maintenance_event m ON m.device_id = d.device_id JOIN dim_supplier p ON p.supplier_id = m.supplier_id"""

# Entities: table, key and properties, as the graph binds them.
_BOUND = {
    "Region": ("dim_region", "region_id region_code region_name"),
    "Site": (
        "dim_site",
        "site_id site_name country region_id site_type contracted_power_kw total_energy_kwh total_energy_cost total_co2_kg",
    ),
    "Device": ("dim_device", "device_id site_id device_type model measurement_unit is_active"),
    "EnergyReading": ("fact_energy_consumption", "reading_id device_id site_id timestamp energy_kwh active_power_kw power_factor"),
    "BillingRecord": ("fact_energy_cost", "cost_id site_id billing_period energy_cost co2_emissions_kg currency"),
    "Supplier": ("dim_supplier", "supplier_id supplier_name supplier_type country"),
    "MaintenanceEvent": (
        "maintenance_event",
        "event_id device_id site_id supplier_id event_date event_type downtime_hours cost description",
    ),
}


def _type_ids() -> str:
    rows, sizes = [], []
    for name, (source, properties) in _BOUND.items():
        rows += [f"('entity', '{name}', NULL)", f"('binding', '{name}', '{source}')"]
        rows += [f"('prop', '{name}', '{c}')" for c in properties.split()]
        sizes.append(f"SELECT '{name}' AS name, count(*) AS bound_rows FROM {source}")
    for link in ("locatedIn", "hasDevice", "produces", "billedFor", "hasMaintenance", "performedBy"):
        rows += [f"('rel', '{link}', NULL)", f"('ctx', '{link}', NULL)"]
    return f"""
        SELECT kind, name, part, bound_rows,
               CASE WHEN kind NOT IN ('binding', 'ctx') THEN
                   (('0x' || substr(sha256(text), 1, 16))::ubigint & 9223372036854775807::ubigint)::bigint END AS id,
               CASE WHEN kind IN ('binding', 'ctx') THEN
                   substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
                   || substr('89ab', (('0x' || substr(h, 17, 1))::int % 4) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) END AS guid
        FROM (SELECT *, sha1(unhex('{_UUID_NAMESPACE}') || text::blob) AS h
              FROM (SELECT *, concat_ws('::', kind, name, part) AS text FROM (VALUES {', '.join(rows)}) v(kind, name, part)))
        LEFT JOIN ({' UNION ALL '.join(sizes)}) USING (name)"""


def _left_out() -> str:
    """Counts of rows read, dropped and values failed, table by table."""
    failing = {
        "dim_site": ("raw_site", "latitude longitude contracted_power_kw", "commissioned_date"),
        "fact_energy_consumption": ("raw_meter_readings", "active_power_kw energy_kwh voltage_v current_a power_factor", ""),
        "fact_energy_cost": ("raw_billing", "energy_consumed_kwh peak_demand_kw tariff_rate energy_cost co2_emissions_kg", ""),
        "dim_supplier": ("supplier_source", "", "contract_since"),
    }
    keys = {
        "dim_site": ("raw_site", "site_id"), "dim_device": ("raw_device", "device_id"), "fact_energy_cost": ("raw_billing", "cost_id"),
        "fact_energy_consumption": ("raw_meter_readings", "reading_id"), "dim_supplier": ("supplier_source", "supplier_id"),
        "maintenance_event": ("maintenance_source", "event_id"),
    }
    parts = []
    for name, (source, key) in keys.items():
        parts += [f"SELECT '{name}' AS table_name, 'read' AS what, NULL::varchar AS column_name, count(*) AS \"rows\" FROM {source}"]
        parts += [f"SELECT '{name}', 'dropped', '{key}', count(*) FROM {source} WHERE {key} IS NULL"]
    for name, (source, numbers, dates) in failing.items():
        for column in (numbers + " " + dates).split():
            kind = "double" if column in numbers.split() else "date"
            parts.append(
                f"SELECT '{name}', 'failed', '{column}', count(*) FROM {source} WHERE {column} IS NOT NULL AND try_cast({column} AS {kind}) IS NULL"
            )
    when = 'FROM raw_meter_readings WHERE try_cast("timestamp" AS timestamp) IS NULL'
    parts.append(f"SELECT 'fact_energy_consumption', 'dropped', 'timestamp', count(*) {when} AND reading_id IS NOT NULL")
    parts.append(f"""SELECT 'fact_energy_consumption', 'failed', 'timestamp', count(*) {when} AND "timestamp" IS NOT NULL""")
    return f'SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE "rows" > 0'


# The extracts with the third delivery, as in voltmark_checks.sample_lake.
_FIRST_READINGS = f"SELECT * FROM ({EXTRACTS['raw_meter_readings']}) WHERE ingested_at = TIMESTAMP '2024-02-01'"
_THIRD = {
    "raw_meter_readings": f"""{EXTRACTS['raw_meter_readings']}
        UNION ALL
        SELECT * REPLACE (
            (try_cast("timestamp" AS timestamp) + INTERVAL 40 DAYS)::varchar AS "timestamp",
            (try_cast(energy_kwh AS double) + 2)::varchar AS energy_kwh, TIMESTAMP '2024-02-06' AS ingested_at)
        FROM ({_FIRST_READINGS}) WHERE reading_id::bigint % 13 = 0
        UNION ALL
        SELECT * FROM ({_FIRST_READINGS}) WHERE reading_id::bigint % 7 = 1
        UNION ALL
        SELECT * REPLACE ('1000' AS energy_kwh, TIMESTAMP '2024-01-15' AS ingested_at)
        FROM ({_FIRST_READINGS}) WHERE reading_id::bigint % 11 = 2
        UNION ALL
        SELECT * REPLACE ('late-' || reading_id AS reading_id, TIMESTAMP '2024-01-15' AS ingested_at)
        FROM ({_FIRST_READINGS}) WHERE reading_id::bigint % 17 = 3""",
    "raw_billing": f"""{EXTRACTS['raw_billing']}
        UNION ALL
        SELECT * REPLACE ('2030-01' AS billing_period, TIMESTAMP '2024-02-07' AS ingested_at)
        FROM ({EXTRACTS['raw_billing']}) WHERE ingested_at = TIMESTAMP '2024-02-01' AND cost_id::bigint % 7 = 0""",
    "raw_site": f"""{EXTRACTS['raw_site']}
        UNION ALL
        SELECT * REPLACE ('MOON' AS region, TIMESTAMP '2024-02-07' AS ingested_at)
        FROM ({EXTRACTS['raw_site']}) WHERE ingested_at = TIMESTAMP '2024-02-01' AND site_id::bigint % 11 = 0""",
}

ORACLES = {
    "dim_region": _sql("SELECT * FROM dim_region"),
    "dim_device": _sql("SELECT * FROM dim_device"),
    "fact_consumption": _sql(f"SELECT {_CONSUMPTION_TEXT} FROM fact_energy_consumption"),
    "fact_cost": _sql("SELECT * FROM fact_energy_cost"),
    "dim_site_totals": _sql(f"SELECT {_SITE_TEXT} FROM dim_site"),
    "dim_supplier": _sql(
        f"SELECT supplier_id, supplier_name, supplier_type, country, {_date('contract_since')} FROM dim_supplier"
    ),
    "maintenance_event_dedup": _sql(f"SELECT * REPLACE ({_time('event_date')}) FROM maintenance_event"),
    "agg_daily_consumption_by_site": _sql(_DAILY),
    "kpi_co2_by_region": _sql(_kpi()),
    "kpi_co2_by_region_and_currency": _sql(_kpi(", currency")),
    "safe_casts": _sql(f"""
        SELECT reading_id, device_id, site_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
               active_power_kw, energy_kwh, voltage_v, current_a, power_factor, {_time('ingested_at')}
        FROM ({_READINGS})"""),
    "site_casts": _sql(f"""
        SELECT site_id, site_name, country, region, {_D('latitude')}, {_D('longitude')}, site_type,
               {_D('contracted_power_kw')},
               strftime(try_cast(commissioned_date AS date), '%Y-%m-%d') AS commissioned_date
        FROM raw_site"""),
    "bool_parse": _sql("SELECT device_id, is_active, lower(is_active) = 'true' AS parsed FROM raw_device"),
    "region_label": _sql("""
        SELECT site_name, CASE region WHEN 'EMEA' THEN 'Europe, Middle East & Africa' WHEN 'AMER' THEN 'Americas'
                                      WHEN 'APAC' THEN 'Asia-Pacific' ELSE region END AS region_name,
               md5(region) AS region_id
        FROM raw_site"""),
    "stable_id63": _sql("""
        SELECT device_id, reading_id,
               CASE WHEN v = 0 THEN 1 ELSE v END::bigint AS id
        FROM (SELECT device_id, reading_id,
                     ('0x' || substr(sha256('reading::' || device_id || '::' || reading_id), 1, 16))::ubigint
                     & 9223372036854775807::ubigint AS v
              FROM raw_meter_readings)"""),
    "stable_uuid5": _sql(f"""
        SELECT device_id, install_location,
               substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
               || substr('89ab', (('0x' || substr(h, 17, 1))::int % 4) + 1, 1)
               || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS guid
        FROM (SELECT device_id, install_location,
                     sha1(unhex('{_UUID_NAMESPACE}') || ('device::' || device_id || '::' || install_location)::blob) AS h
              FROM raw_device)"""),
    "graph_type_ids": _sql(_type_ids()),
    "id_ambiguities": _sql("""
        SELECT CASE WHEN v = 0 THEN 1 ELSE v END::bigint AS id, other AS first, one AS second, 'separator' AS cause
        FROM (SELECT DISTINCT ('0x' || substr(sha256(device_id || '::' || voltage_v || '::' || reading_id), 1, 16))::ubigint
                              & 9223372036854775807::ubigint AS v,
                     device_id || '::' || voltage_v || '|' || reading_id AS one,
                     device_id || '|' || voltage_v || '::' || reading_id AS other
              FROM raw_meter_readings WHERE device_id IS NOT NULL AND reading_id IS NOT NULL)"""),
    "ratio_and_display": """
        SELECT l_orderkey, l_linenumber, v / nullif(round(l_discount * 100), 0) AS per_percent,
               (CASE WHEN (v * 10)::decimal(20, 4) % 1 >= 0.5 THEN ceil(v * 10) ELSE floor(v * 10) END) / 10 AS rounded,
               format('{:,}', floor(v)::bigint) || '.' || lpad(((v - floor(v)) * 1000)::bigint::varchar, 3, '0') AS shown_3
        FROM (SELECT *, round(l_extendedprice * 100) * 0.25::double AS v FROM lineitem)""",
    "metric_totals": _sql("""
        SELECT *, total_energy_cost / total_energy AS cost_per_kwh, total_co2 / total_energy AS co2_intensity
        FROM (SELECT sum(energy_cost) AS total_energy_cost, sum(co2_emissions_kg) AS total_co2 FROM fact_energy_cost),
             (SELECT sum(energy_kwh) AS total_energy, sum(power_factor) / count(power_factor) AS avg_power_factor
              FROM fact_energy_consumption),
             (SELECT count(*) AS site_count FROM dim_site)"""),
    "metric_by_region": _measured("region_name", _ALL),
    "metric_by_country": _measured("country", _ALL),
    "metric_by_site_name": _measured("site_name", "cost_per_kwh co2_intensity"),
    "metric_by_device_type": _sql(
        """SELECT device_type, sum(energy_kwh) AS total_energy,
                  sum(power_factor) / count(power_factor) AS avg_power_factor FROM energy_star GROUP BY device_type""",
        **_STAR,
    ),
    "metric_cross_fact_ratio": _measured("region_name country", "total_energy_cost total_energy cost_per_kwh"),
    "metric_unreachable_repeat": _sql(
        """SELECT device_type, total_energy, (SELECT sum(energy_cost) FROM fact_energy_cost) AS total_energy_cost,
                  (SELECT count(*) FROM dim_site) AS site_count
           FROM (SELECT device_type, max(total_energy) AS total_energy
                 FROM (SELECT device_type, sum(energy_kwh) AS total_energy FROM energy_star GROUP BY device_type
                       UNION ALL SELECT device_type, NULL FROM dim_device) GROUP BY device_type)""",
        **_STAR,
    ),
    "metric_partly_reachable": _sql(
        _PARTLY.format(column="region_name"),
        **_STAR,
    ),
    "metric_partly_reachable_by_site": _sql(_PARTLY.format(column="site_name"), **_STAR),
    "metric_blank_filtered": _sql(
        """SELECT country, sum(total_energy) AS total_energy, sum(total_co2) AS total_co2,
                  sum(site_count)::bigint AS site_count
           FROM (SELECT country, energy_kwh AS total_energy, NULL::double AS total_co2, NULL::bigint AS site_count
                 FROM energy_star WHERE region_name IS NULL
                 UNION ALL SELECT country, NULL, co2_emissions_kg, NULL FROM cost_star WHERE region_name IS NULL
                 UNION ALL SELECT country, NULL, NULL, 1 FROM site_star WHERE region_name IS NULL)
           GROUP BY country HAVING sum(total_energy) IS NOT NULL OR sum(total_co2) IS NOT NULL OR sum(site_count) > 0""",
        **_STAR,
    ),
    "metric_blank_member": _measured("site_type", "total_energy total_co2"),
    "metric_by_period": _sql("""
        SELECT billing_period, sum(co2_emissions_kg) AS total_co2, sum(energy_cost) AS total_energy_cost
        FROM fact_energy_cost GROUP BY billing_period"""),
    # The device filter reaches readings only.
    "metric_filtered": _sql(
        """SELECT country, max(total_energy) AS total_energy, max(total_energy_cost) AS total_energy_cost,
                  max(site_count) AS site_count
           FROM (SELECT country, sum(energy_kwh) AS total_energy, NULL::double AS total_energy_cost,
                        NULL::bigint AS site_count
                 FROM energy_star
                 WHERE region_name IN ('Americas', 'Asia-Pacific') AND device_type IN ('LARGE', 'SMALL') GROUP BY country
                 UNION ALL
                 SELECT country, NULL, sum(energy_cost), NULL FROM cost_star
                 WHERE region_name IN ('Americas', 'Asia-Pacific') GROUP BY country
                 UNION ALL
                 SELECT country, NULL, NULL, count(*) FROM site_star
                 WHERE region_name IN ('Americas', 'Asia-Pacific') GROUP BY country)
           GROUP BY country""",
        **_STAR,
    ),
    "metric_filtered_with_blank": _sql(
        """SELECT country, max(total_energy) AS total_energy, max(total_energy_cost) AS total_energy_cost,
                  max(site_count) AS site_count
           FROM (SELECT s.country, sum(f.energy_kwh) AS total_energy, NULL::double AS total_energy_cost, NULL::bigint AS site_count
                 FROM fact_energy_consumption f LEFT JOIN dim_site s USING (site_id) LEFT JOIN dim_region r USING (region_id)
                      LEFT JOIN dim_device d ON d.device_id = f.device_id
                 WHERE coalesce(r.region_code, 'AMER') = 'AMER' AND coalesce(d.device_type, 'LARGE') = 'LARGE' GROUP BY s.country
                 UNION ALL
                 SELECT s.country, NULL, sum(f.energy_cost), NULL
                 FROM fact_energy_cost f LEFT JOIN dim_site s USING (site_id) LEFT JOIN dim_region r USING (region_id)
                 WHERE coalesce(r.region_code, 'AMER') = 'AMER' GROUP BY s.country
                 UNION ALL
                 SELECT s.country, NULL, NULL, count(*) FROM dim_site s LEFT JOIN dim_region r USING (region_id)
                 WHERE coalesce(r.region_code, 'AMER') = 'AMER' GROUP BY s.country)
           GROUP BY country
           HAVING max(total_energy) IS NOT NULL OR max(total_energy_cost) IS NOT NULL OR max(site_count) > 0""",
    ),
    "metric_inactive_relationship": _sql(
        """SELECT s.country, sum(e.energy_kwh) AS total_energy
           FROM energy_star e LEFT JOIN dim_site s ON s.site_id = e.device_site
           GROUP BY s.country HAVING sum(e.energy_kwh) IS NOT NULL""",
        **_STAR,
    ),
    "metric_formatted": _sql(
        """SELECT country, format('{:,}', floor(cost)::bigint) || '.'
                           || lpad(round((cost - floor(cost)) * 100)::bigint::varchar, 2, '0') AS total_energy_cost,
                  format('{:,}', site_count) AS site_count
           FROM (SELECT country, sum(energy_cost) AS cost FROM cost_star GROUP BY country)
           LEFT JOIN (SELECT country AS site_country, count(*) AS site_count FROM site_star GROUP BY country)
                  ON country IS NOT DISTINCT FROM site_country""",
        **_STAR,
    ),
    "report_columns": _sql(f"""
        SELECT site_name, country, latitude, longitude, site_type, contracted_power_kw, {_date('commissioned_date')}
        FROM dim_site"""),
    **{name: _sql(select) for name, select in _PROPERTIES.items()},
    "graph_nodes": _sql(_NODES),
    "graph_edges": _sql(_EDGES),
    "graph_refresh": _sql(f"""
        SELECT 'node' AS kind, type AS name, count(*) AS "rows" FROM ({_NODES}) GROUP BY type
        UNION ALL SELECT 'edge', rel, count(*) FROM ({_EDGES}) GROUP BY rel"""),
    "graph_stored_walk": _sql(f"""
        SELECT s.site_id AS step_0, d.device_id AS step_1, m.event_id AS step_2, m.supplier_id AS step_3
        FROM dim_device d JOIN maintenance_event m ON m.device_id = d.device_id JOIN dim_site s ON s.site_id = d.site_id
        WHERE s.site_id LIKE '%3' AND m.supplier_id IS NOT NULL"""),
    "graph_traverse_supplier": _sql(
        f"SELECT s.site_id, s.site_name, d.device_id, m.event_id, p.supplier_id, p.supplier_name, p.country {_EVENT_WALK}"
    ),
    "graph_traverse_back": _sql(f"""
        SELECT p.supplier_id, m.event_id, d.device_id, s.site_id, r.region_id, r.region_code
        {_EVENT_WALK} JOIN dim_region r ON r.region_id = s.region_id"""),
    "graph_traverse_seeded": _sql(f"""
        SELECT s.site_id, s.site_name, d.device_id, d.device_type, m.event_id, p.supplier_id, p.supplier_name, p.country {_EVENT_WALK}
        WHERE lower(s.site_type) = 'building' AND d.device_type IN ('LARGE', 'SMALL') AND p.supplier_type = 'OEM'"""),
    "graph_readings_by_region": _sql("""
        SELECT region_name, device_type, count(*) AS readings, sum(energy_kwh) AS energy_kwh
        FROM fact_energy_consumption f LEFT JOIN dim_device d USING (device_id)
             LEFT JOIN dim_site s ON s.site_id = d.site_id LEFT JOIN dim_region USING (region_id)
        GROUP BY region_name, device_type"""),
    "cost_by_region": _sql(
        "SELECT region_name, sum(energy_cost) AS total_energy_cost FROM cost_star GROUP BY region_name", **_STAR
    ),
    "cost_by_region_via_graph": _sql("""
        SELECT region_name, sum(total_energy_cost) AS total_energy_cost
        FROM dim_site JOIN dim_region USING (region_id) GROUP BY region_name"""),
    "top_co2_site": _sql("""
        SELECT site_id, site_name, country, total_co2_kg FROM dim_site ORDER BY total_co2_kg DESC, site_id LIMIT 1"""),
    "top_sites_by_cost": _sql("""
        SELECT site_id, total_energy_cost FROM dim_site ORDER BY total_energy_cost DESC, site_id LIMIT 10"""),
    "co2_intensity_by_site": _measured("site_name", "co2_intensity").replace(
        "SELECT site_name, co2_intensity FROM", "SELECT site_name, round(co2_intensity, 3) AS co2_intensity FROM"
    ),
    "supplier_downtime_by_region": _sql(f"""
        SELECT region_name, m.supplier_id, p.supplier_name, count(*) AS events, sum(downtime_hours) AS downtime_hours,
               sum(cost) AS cost
        FROM maintenance_event m LEFT JOIN ({_DEVICE_REGION}) r ON r.device_id = m.device_id
             LEFT JOIN dim_supplier p ON p.supplier_id = m.supplier_id
        GROUP BY region_name, m.supplier_id, p.supplier_name"""),
    "energy_and_maintenance_by_region": _sql(f"""
        SELECT region_name, max(energy_kwh) AS energy_kwh, max(co2_kg) AS co2_kg, max(downtime_hours) AS downtime_hours,
               max(maintenance_cost) AS maintenance_cost
        FROM (SELECT region_name, sum(energy_kwh) AS energy_kwh, NULL::double AS co2_kg,
                     NULL::double AS downtime_hours, NULL::double AS maintenance_cost
              FROM fact_energy_consumption f LEFT JOIN ({_DEVICE_REGION}) r ON r.device_id = f.device_id GROUP BY region_name
              UNION ALL
              SELECT region_name, NULL, sum(co2_emissions_kg), NULL, NULL FROM cost_star GROUP BY region_name
              UNION ALL
              SELECT region_name, NULL, NULL, sum(downtime_hours), sum(cost)
              FROM maintenance_event m LEFT JOIN ({_DEVICE_REGION}) r ON r.device_id = m.device_id GROUP BY region_name)
        GROUP BY region_name""", **_STAR),
    "site_totals_with_nan": _sql(
        f"""SELECT site_id, CASE WHEN isnan(total_energy_kwh) THEN 0 ELSE total_energy_kwh END AS total_energy_kwh,
                   total_energy_cost, total_co2_kg
            FROM ({_sites('spoiled')})""",
        spoiled="""SELECT site_id, CASE WHEN active_power_kw > 40 THEN 'NaN'::double ELSE energy_kwh END AS energy_kwh
                   FROM fact_energy_consumption""",
    ),
    "snapshot_drift": _sql(
        """SELECT a.site_id, a.total_energy_kwh, a.total_energy_cost, a.total_co2_kg,
                  b.total_energy_kwh AS live_total_energy_kwh, b.total_energy_cost AS live_total_energy_cost,
                  b.total_co2_kg AS live_total_co2_kg
           FROM stored_site a JOIN dim_site b USING (site_id)
           WHERE a.total_energy_kwh <> b.total_energy_kwh""",
        first_consumption=_consumption("AND ingested_at < TIMESTAMP '2024-02-02'"),
        stored_site=_sites("first_consumption"),
    ),
    "drifted_site_months": _sql(
        """SELECT site_id, strftime(reading_date, '%Y-%m') AS month, sum(a)::bigint AS stored_readings, sum(b)::bigint AS live_readings
           FROM (SELECT site_id, reading_date, count(*) FILTER (WHERE side = 'a') AS a, count(*) FILTER (WHERE side = 'b') AS b
                 FROM (SELECT 'a' AS side, site_id, reading_date FROM first_consumption
                       UNION ALL SELECT 'b', site_id, reading_date FROM fact_energy_consumption)
                 GROUP BY site_id, reading_date) n
           WHERE EXISTS (SELECT 1 FROM changed c
                         WHERE c.site_id IS NOT DISTINCT FROM n.site_id AND c.reading_date = n.reading_date)
           GROUP BY site_id, month""",
        first_consumption=_consumption("AND ingested_at < TIMESTAMP '2024-02-02'"),
        changed="""(SELECT * FROM first_consumption EXCEPT SELECT * FROM fact_energy_consumption)
                   UNION ALL (SELECT * FROM fact_energy_consumption EXCEPT SELECT * FROM first_consumption)""",
    ),
    "landing": """
        SELECT o_orderkey::varchar AS cost_id, o_custkey::varchar AS site_id,
               strftime(o_orderdate, '%Y-%m') AS billing_period, year(o_orderdate)::varchar AS energy_consumed_kwh,
               NULL::varchar AS peak_demand_kw, '0.125' AS tariff_rate,
               CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END AS energy_cost,
               strftime(o_orderdate, '%Y-%m-%d') AS co2_emissions_kg, o_orderstatus AS currency,
               'orders' AS source_file, true AS stamped
        FROM orders""",
    "landing_files": """
        SELECT file, currency, count(*) AS "rows", count(DISTINCT cost_id) AS bills, min(site_id) AS least_site, '[1, 0, 1, 0]' AS landings
        FROM (SELECT 'orders.parquet' AS file, o_orderstatus AS currency, o_orderkey::varchar AS cost_id, o_custkey::varchar AS site_id FROM orders
              UNION ALL SELECT 'customer.parquet', c_mktsegment, 'c' || c_custkey, c_custkey::varchar FROM customer)
        GROUP BY ALL""",
    "lake_run_counts": _sql(f"""
        SELECT 'dim_region' AS table_name, count(*) AS row_count FROM dim_region
        UNION ALL SELECT 'dim_site', count(*) FROM dim_site
        UNION ALL SELECT 'dim_device', count(*) FROM dim_device
        UNION ALL SELECT 'fact_energy_consumption', count(*) FROM fact_energy_consumption
        UNION ALL SELECT 'fact_energy_cost', count(*) FROM fact_energy_cost
        UNION ALL SELECT 'dim_supplier', count(*) FROM dim_supplier
        UNION ALL SELECT 'maintenance_event', count(*) FROM maintenance_event
        UNION ALL SELECT 'agg_daily_consumption_by_site', count(*) FROM ({_DAILY})
        UNION ALL SELECT 'kpi_co2_by_region', count(*) FROM ({_kpi()})"""),
    "intake_report": _sql(_left_out()),
    "dropped_by_reason": _sql(f"""
        SELECT table_name, missing, {_time('ingested_at')}, count(*) AS "rows", min(id) AS least_id
        FROM (SELECT 'dim_site' AS table_name, 'site_id' AS missing, ingested_at, NULL::varchar AS id FROM raw_site WHERE site_id IS NULL
              UNION ALL SELECT 'dim_device', 'device_id', ingested_at, site_id FROM raw_device WHERE device_id IS NULL
              UNION ALL SELECT 'fact_energy_cost', 'cost_id', ingested_at, site_id FROM raw_billing WHERE cost_id IS NULL
              UNION ALL SELECT 'fact_energy_consumption', CASE WHEN reading_id IS NULL THEN 'reading_id' ELSE 'timestamp' END,
                               ingested_at, coalesce(reading_id, site_id, device_id)
                        FROM raw_meter_readings
                        WHERE reading_id IS NULL OR try_cast("timestamp" AS timestamp) IS NULL)
        GROUP BY ALL"""),
    "lake_gold_daily": _sql(_DAILY),
    "stored_metric_by_region": _measured("region_name", _ALL),
    "stored_metric_one_day": _sql(
        """SELECT region_name, sum(energy_kwh) AS total_energy,
                  sum(power_factor) / nullif(count(power_factor), 0) AS avg_power_factor
           FROM (SELECT f.*, s.region_name FROM fact_energy_consumption f LEFT JOIN site_star s USING (site_id))
           WHERE reading_date = DATE '2024-01-05'
           GROUP BY region_name""",
        **_STAR,
    ),
    "stored_traverse_supplier": _sql(
        f"SELECT s.site_id, s.site_name, d.device_id, m.event_id, p.supplier_id, p.supplier_name, p.country {_EVENT_WALK}"
    ),
    "incremental_consumption": _sql(f"SELECT {_CONSUMPTION_TEXT} FROM fact_energy_consumption", **_THIRD),
    "incremental_daily": _sql(_DAILY, **_THIRD),
    "incremental_cost": _sql("SELECT * FROM fact_energy_cost", **_THIRD),
    "incremental_sites": _sql(f"SELECT {_SITE_TEXT} FROM dim_site", **_THIRD),
    "incremental_kpi": _sql(_kpi(), **_THIRD),
    "lifecycle_truncate": _sql(f"""
        SELECT 'dim_region' AS table_name, count(*) AS first_run, count(*) AS second_run FROM dim_region
        UNION ALL SELECT 'dim_site', count(*), count(*) FROM dim_site
        UNION ALL SELECT 'dim_device', count(*), count(*) FROM dim_device
        UNION ALL SELECT 'fact_energy_consumption', count(*), 0 FROM fact_energy_consumption
        UNION ALL SELECT 'fact_energy_cost', count(*), 0 FROM fact_energy_cost
        UNION ALL SELECT 'agg_daily_consumption_by_site', count(*), 0 FROM ({_DAILY})
        UNION ALL SELECT 'kpi_co2_by_region', count(*), 0 FROM ({_kpi()})"""),
    "lifecycle_reset_gold": _sql(_kpi()),
    "lake_appended_twice": _sql(f"SELECT {_CONSUMPTION_TEXT} FROM fact_energy_consumption"),
}
