"""The same queries as SQL over the star tables, for checking results.

Each entry is an independent formulation: it starts from the tables, shares only the
common table expressions below, and restates the expected result.
"""

from __future__ import annotations

from snapharbor.binding.star import SALT
from snapharbor.operators.scans import AUDIT_PATTERNS
from snapharbor.plans.contracts import CONTRACTS

# Common table expressions in dependency order.
PARTS = {
    "veh": f"""
        SELECT o_orderkey, sha256('{SALT}:' || CAST(o_orderkey AS VARCHAR)) AS vid,
               n_name AS brand, c_mktsegment AS model, o_orderstatus AS vtype,
               o_orderpriority AS colour, CAST(o_orderdate AS DATE) AS rdate,
               CAST(year(o_orderdate) AS INTEGER) AS ryear,
               'run_' || CAST(year(o_orderdate) AS VARCHAR) AS run
        FROM orders
        LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "line1": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_returnflag DESC) = 1""",
    "fu": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_returnflag, l_shipdate,
               l_quantity, l_tax,
               sha256('{SALT}:' || CAST(l_orderkey AS VARCHAR)) AS vid,
               l_linenumber AS seq,
               CASE l_returnflag WHEN 'A' THEN 'Elektriciteit' WHEN 'N' THEN 'Waterstof'
                    ELSE CASE l_linestatus WHEN 'O' THEN 'Benzine' ELSE 'Diesel' END
               END AS ftype,
               CASE WHEN l_linestatus = 'F' THEN 'Euro 6' END AS emission,
               CASE WHEN l_discount > 0 THEN l_quantity END AS co2,
               CASE WHEN l_tax > 0 THEN l_quantity END AS kw,
               CASE WHEN l_linenumber % 3 = 0 THEN 'OVC' END AS hybrid
        FROM line1""",
    "fur": "SELECT fu.*, run FROM fu JOIN veh USING (o_orderkey)",
    "prof": """
        SELECT vid, count(*) AS n,
               count(*) FILTER (ftype = 'Elektriciteit') > 0 AS e,
               count(*) FILTER (ftype = 'Waterstof') > 0 AS h,
               count(*) FILTER (ftype IN ('Benzine', 'Diesel')) > 0 AS o
        FROM fu GROUP BY vid""",
    "cat": """
        SELECT *, CASE WHEN h THEN 'Hydrogen electric' WHEN o THEN 'Hybrid electric'
                       ELSE 'Battery electric' END AS cat
        FROM prof WHERE e OR h""",
    "runs": """
        SELECT 'run_' || CAST(y AS VARCHAR) AS ingestion_id, first AS started_at,
               last AS completed_at, 'succeeded' AS status,
               CASE WHEN y % 2 = 0 THEN 0 ELSE 10000 END AS sample_limit,
               CAST(n AS INTEGER) AS vehicle_rows, CAST(done AS INTEGER) AS fuel_rows,
               CAST(urgent AS INTEGER) AS duplicate_payloads,
               'resumable_snapshot' AS ingestion_mode,
               CASE WHEN y % 2 <> 0 THEN CAST(10000 AS BIGINT) END AS requested_limit,
               1000 AS page_size, CAST(ceil(n / 1000.0) AS INTEGER) AS pages_requested,
               CAST(n + done AS BIGINT) AS source_rows_received,
               CAST(n AS BIGINT) AS matched_vehicles,
               CAST(n - done AS BIGINT) AS rejected_rows,
               secs AS active_duration_seconds, secs + 1 AS wall_clock_elapsed_seconds,
               CASE WHEN secs > 0 THEN (n + done) / secs ELSE 0.0 END
                   AS processed_rows_per_second,
               'completed' AS checkpoint_status, y % 3 = 0 AS resumed,
               CASE WHEN y % 3 = 0 THEN 1 ELSE 0 END AS resume_count
        FROM (SELECT *, CASE WHEN y = 1995 THEN CAST(0 AS DOUBLE)
                             ELSE CAST(n AS DOUBLE) / 8 END AS secs
              FROM (SELECT year(o_orderdate) AS y, count(*) AS n, min(o_orderdate) AS first,
                           max(o_orderdate) AS last,
                           count(*) FILTER (o_orderstatus = 'F') AS done,
                           count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent
                    FROM orders GROUP BY 1))""",
    "snap": """
        SELECT md5(run || '|' || veh.vid) AS skey, veh.*, n, e, h, o, cat, started_at,
               md5(brand || '|' || model || '|' || vtype) AS mkey,
               CAST(strftime(rdate, '%Y%m%d') AS INTEGER) AS dkey,
               md5(concat_ws('|', cat, CAST(e AS VARCHAR), CAST(h AS VARCHAR),
                             CAST(o AS VARCHAR))) AS pkey
        FROM veh JOIN cat USING (vid) LEFT JOIN runs ON runs.ingestion_id = run""",
    "ff": """
        SELECT md5(concat_ws('|', fur.run, fur.vid, seq)) AS fkey, skey, fur.*,
               brand, model, vtype, ryear, rdate, cat
        FROM fur JOIN snap USING (vid, run)""",
    "over": """
        SELECT skey AS vehicle_snapshot_key, run AS snapshot_ingestion_id,
               started_at AS snapshot_started_at, vid AS vehicle_key, brand, model,
               vtype AS vehicle_type, colour AS primary_colour,
               CAST(NULL AS VARCHAR) AS secondary_colour, rdate AS registration_date,
               ryear AS registration_year, cat AS powertrain_category, e AS has_electric,
               h AS has_hydrogen, o AS has_other_fuel, n AS fuel_record_count,
               1 AS vehicle_count
        FROM snap""",
    "met": """
        SELECT ftype AS fuel_type, brand, model, ryear AS registration_year,
               cat AS powertrain_category, count(DISTINCT vid) AS vehicle_count,
               round(avg(co2) * 100) / 100 AS avg_reported_co2_combined_g_km,
               round(avg(kw) * 100) / 100 AS avg_reported_net_max_power_kw
        FROM ff GROUP BY 1, 2, 3, 4, 5""",
    "rawv": r"""
        SELECT CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END
                   AS id,
               CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE model END AS model,
               CASE WHEN o_orderkey % 9 >= 4 THEN rdate END AS rdate, brand, colour, vtype
        FROM veh""",
    "rawf": """
        SELECT CASE WHEN l_partkey % 97 = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END
                   AS id, seq AS line,
               CASE seq WHEN 3 THEN '0' WHEN 5 THEN 'x' WHEN 6 THEN NULL
                        ELSE ' ' || CAST(seq AS VARCHAR) END AS seq_text,
               CASE WHEN seq IN (3, 5, 6) THEN 1 ELSE seq END AS seq,
               CASE WHEN l_suppkey % 13 <> 0 THEN ftype END AS ftype, emission,
               CASE seq % 5 WHEN 1 THEN l_quantity + 0.5 WHEN 3 THEN l_quantity END AS co2,
               CASE WHEN l_tax > 0 THEN l_quantity + 0.25 END AS kw, hybrid
        FROM fu""",
    "anch": """
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id
        FROM fu WHERE ftype IN ('Elektriciteit', 'Waterstof')""",
    "apage": """
        SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 1000 AS BIGINT) AS page,
               CAST((row_number() OVER (ORDER BY id) - 1) % 1000 AS BIGINT) AS pos
        FROM anch""",
    "anchors": """
        SELECT CAST(o_orderkey // 1000 AS BIGINT) AS page,
               CASE WHEN o_orderkey % 40 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END
                   AS id
        FROM orders""",
    "idstate": """
        SELECT page, id, v, f, id <> '' AND v > 0 AND f > 0 AS complete
        FROM anchors
        LEFT JOIN (SELECT id, count(*) AS v FROM rawv WHERE id <> '' GROUP BY 1) USING (id)
        LEFT JOIN (SELECT id, count(*) AS f FROM rawf WHERE id <> '' GROUP BY 1) USING (id)""",
    "counters": """
        SELECT page, CAST(sum(1 + coalesce(v, 0) + coalesce(f, 0)) AS BIGINT) AS source_rows,
               CAST(sum(CASE WHEN complete THEN v ELSE 0 END) AS BIGINT) AS matched,
               CAST(sum(CASE WHEN complete THEN f ELSE 0 END) AS BIGINT) AS fuel_rows,
               CAST(count(*) FILTER (complete IS NOT TRUE) AS BIGINT) AS rejected
        FROM idstate GROUP BY page""",
    "opage": """
        SELECT CAST((row_number() OVER (ORDER BY k) - 1) // 1000 AS BIGINT) AS page,
               CAST((row_number() OVER (ORDER BY k) - 1) % 1000 AS INTEGER) AS pos, *
        FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS p,
                     o_orderstatus AS s FROM orders)""",
    "odigest": """
        SELECT page, count(*) AS row_count, sha256('[' || string_agg(
                   '{"o_orderkey":"' || k || '","o_orderpriority":"' || p
                   || '","o_orderstatus":"' || s || '"}', ',' ORDER BY pos) || ']') AS digest
        FROM opage GROUP BY page""",
    "dirty": """
        SELECT CASE o_orderkey % 100 WHEN 2 THEN NULL WHEN 1 THEN upper(vid) ELSE vid END
                   AS vid,
               CASE WHEN o_orderkey % 50 = 7 THEN 1850 ELSE ryear END AS ryear
        FROM veh, range(2) AS r(i)
        WHERE i = 0 OR o_orderkey % 20 = 5""",
    "gate": """
        SELECT 'null_vehicle_hashes' AS "check",
               (SELECT count(*) FROM dirty WHERE vid IS NULL) AS violations
        UNION ALL SELECT 'duplicate_vehicles',
               (SELECT count(*) FROM (SELECT vid FROM dirty GROUP BY vid HAVING count(*) > 1))
        UNION ALL SELECT 'orphan_fuels',
               (SELECT count(*) FROM fu
                WHERE NOT EXISTS (SELECT 1 FROM dirty WHERE dirty.vid = fu.vid))
        UNION ALL SELECT 'plain_identifier_columns', 0
        UNION ALL SELECT 'invalid_vehicle_hashes',
               (SELECT count(*) FROM dirty WHERE NOT regexp_matches(vid, '^[0-9a-f]{64}$'))
        UNION ALL SELECT 'invalid_registration_years',
               (SELECT count(*) FROM dirty
                WHERE ryear < 1900 OR ryear > year(current_date) + 1)
        UNION ALL SELECT 'empty_vehicle_staging',
               (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM dirty)""",
    "known": """
        SELECT lang, sha256(text) AS digest, max(n_chars) AS n
        FROM documents WHERE source = 'src0' GROUP BY 1, 2""",
    "arrive": """
        SELECT doc_id, lang, sha256(text) AS digest, n_chars, source,
               row_number() OVER (PARTITION BY lang, sha256(text) ORDER BY doc_id) > 1
               OR (lang, sha256(text)) IN (SELECT (lang, digest) FROM known) AS dup
        FROM documents""",
}
PARTS["fur"] = """
        SELECT fu.*, 'run_' || CAST(year(o_orderdate) AS VARCHAR) AS run
        FROM fu JOIN orders ON o_orderkey = l_orderkey"""

STAGED_FUEL = """vid AS vehicle_id_hash, seq AS fuel_sequence, ftype AS fuel_type,
    emission AS emission_code, co2 AS co2_combined_g_km, kw AS net_max_power_kw,
    hybrid AS hybrid_class"""
VEHICLES = "CAST(sum(vehicle_count) AS BIGINT)"
MULTI = "CAST(count(*) FILTER (fuel_record_count > 1) AS BIGINT)"
FUEL_SLICE = """FROM ff WHERE ryear IN (1996, 1997, 1998) AND hybrid = 'OVC'
    GROUP BY cat, ftype"""


def _with(body: str) -> str:
    """Prefix the common table expressions that ``body`` needs, directly or not."""
    import re

    needed: set[str] = set()
    todo = [body]
    while todo:
        sql = todo.pop()
        for name, part in PARTS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                todo.append(part)
    # A part may use a later one, so order by use.
    ordered: list[str] = []

    def place(name: str) -> None:
        for other in PARTS:
            if (
                other != name
                and other in needed
                and other not in ordered
                and re.search(rf"\b(FROM|JOIN)\s+{other}\b", PARTS[name])
            ):
                place(other)
        if name not in ordered:
            ordered.append(name)

    for name in PARTS:
        if name in needed:
            place(name)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({PARTS[n]})" for n in ordered)
    return f"WITH {ctes}\n{body}"


def _fuel_measure(expr: str, name: str) -> str:
    return f"""SELECT cat AS powertrain_category, ftype AS fuel_type, {expr} AS {name}
        {FUEL_SLICE}"""


def _by_fuel(expr: str, name: str) -> str:
    return f"SELECT ftype AS fuel_type, {expr} AS {name} FROM ff GROUP BY 1"


def _gate(check: str) -> str:
    return f'SELECT * FROM gate WHERE "check" = \'{check}\''


def _scan(patterns: dict[str, tuple]) -> str:
    tests = [
        f"SELECT doc_id, '{label}' AS label FROM documents WHERE regexp_matches(text, '{p}')"
        for label, (p, _) in patterns.items()
    ]
    return "\nUNION ALL ".join(tests)


def _contract_sql(o: dict[str, str]) -> str:
    """One SELECT per declared test, each over the SQL of its model."""
    snapshot_rows = {
        "stg_vehicles": "vehicle_id_hash",
        "stg_fuels": "vehicle_id_hash",
        "dim_vehicle": "vehicle_key",
    }

    def model(name: str) -> str:
        key = snapshot_rows.get(name)
        kept = f" WHERE {key} IN (SELECT vid FROM cat)" if key else ""
        return f"(SELECT * FROM ({o[name]}){kept})"

    tests = []

    def add(kind: str, name: str, column: str, rows: str) -> None:
        tests.append(
            f"""SELECT '{kind}:{name}.{column}' AS "check", count(*) AS violations
            FROM ({rows})"""
        )

    for name, contract in CONTRACTS.items():
        for c in contract.not_null:
            add("not_null", name, c, f"SELECT 1 FROM {model(name)} WHERE {c} IS NULL")
        for c, values in contract.accepted.items():
            listed = ", ".join(repr(v) for v in values)
            add("accepted_values", name, c,
                f"SELECT 1 FROM {model(name)} WHERE {c} NOT IN ({listed})")
        uniques = {c: c for c in contract.unique}
        if name == "stg_fuels":
            uniques["vehicle_and_sequence"] = "vehicle_id_hash, fuel_sequence"
        if name == "mart_ev_metrics":
            uniques["metric_keys"] = (
                "fuel_type, brand, model, registration_year, powertrain_category"
            )
        for c, expr in uniques.items():
            add("unique", name, c,
                f"SELECT 1 FROM {model(name)} GROUP BY {expr} HAVING count(*) > 1")
        for c, (parent, pc) in contract.parents.items():
            add("relationships", name, c,
                f"""SELECT DISTINCT {c} FROM {model(name)} WHERE {c} IS NOT NULL
                AND {c} NOT IN (SELECT {pc} FROM {model(parent)})""")
    return "\nUNION ALL ".join(tests)


def _sql() -> dict[str, str]:
    from snapharbor.binding.queries import DOCUMENT_PATTERNS

    o = {}
    # --- reports ---
    mix = f"""SELECT powertrain_category, {VEHICLES} AS vehicles FROM over
        GROUP BY 1"""
    o["rpt_powertrain_mix"] = mix
    o["rpt_powertrain_cards"] = mix
    brands = f"""SELECT brand, {VEHICLES} AS vehicles FROM over GROUP BY 1
        QUALIFY rank() OVER (ORDER BY {VEHICLES} DESC) <= """
    o["rpt_top_brands"] = brands + "10"
    o["rpt_registration_year"] = f"""SELECT registration_year, {VEHICLES} AS vehicles
        FROM over GROUP BY 1"""
    o["rpt_snapshot_started"] = (
        "SELECT max(snapshot_started_at) AS snapshot_started_at FROM over"
    )
    o["rpt_vehicle_total"] = f"SELECT {VEHICLES} AS vehicles FROM over"
    o["rpt_model_matrix"] = f"""SELECT brand, model, vehicle_type,
            CAST(grouping_id(brand, model, vehicle_type) AS INTEGER) AS level,
            {VEHICLES} AS vehicles, {MULTI} / {VEHICLES} AS multi_fuel_share
        FROM over GROUP BY ROLLUP (brand, model, vehicle_type)"""
    o["rpt_brand_by_powertrain"] = f"""SELECT brand, powertrain_category,
            {VEHICLES} AS vehicles
        FROM over WHERE brand IN (SELECT brand FROM ({brands}15)) GROUP BY 1, 2"""
    o["rpt_fuel_vehicles"] = _by_fuel("count(DISTINCT skey)", "vehicles_with_fuel")
    o["rpt_fuel_co2"] = _by_fuel("avg(co2)", "avg_co2")
    o["rpt_fuel_power"] = _by_fuel("avg(kw)", "avg_power")
    o["rpt_fuel_cards"] = """SELECT count(DISTINCT skey) AS vehicles_with_fuel,
            count(*) AS fuel_records, avg(co2) AS avg_co2, avg(kw) AS avg_power,
            count(co2) / count(*) AS co2_coverage, count(kw) / count(*) AS power_coverage
        FROM ff"""
    o["rpt_fuel_matrix"] = """SELECT ftype AS fuel_type, hybrid AS hybrid_class,
            CAST(grouping_id(ftype, hybrid) AS INTEGER) AS level,
            count(DISTINCT skey) AS vehicles_with_fuel, count(*) AS fuel_records,
            count(co2) / count(*) AS co2_coverage, count(kw) / count(*) AS power_coverage
        FROM ff GROUP BY ROLLUP (ftype, hybrid)"""
    # --- example queries ---
    o["q_top_brands"] = f"""SELECT brand, {VEHICLES} AS ev_vehicle_count FROM over
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
    o["q_year_profile"] = f"""SELECT registration_year, powertrain_category,
            {VEHICLES} AS vehicle_count
        FROM over WHERE registration_year IS NOT NULL GROUP BY 1, 2"""
    o["q_metrics_top50"] = """SELECT * FROM met ORDER BY vehicle_count DESC, brand, model,
        fuel_type, registration_year, powertrain_category LIMIT 50"""
    o["q_snapshot_grain"] = """SELECT run AS snapshot_ingestion_id,
            count(*) AS vehicle_snapshot_rows, CAST(sum(n) AS BIGINT) AS reported_fuel_rows
        FROM snap GROUP BY 1"""
    o["q_run_audit"] = """SELECT ingestion_id, ingestion_mode, requested_limit, started_at,
            completed_at, status, page_size, pages_requested, source_rows_received,
            vehicle_rows, fuel_rows, rejected_rows, duplicate_payloads,
            active_duration_seconds, wall_clock_elapsed_seconds,
            processed_rows_per_second, checkpoint_status, resumed, resume_count FROM runs"""
    # --- measures ---
    o["m_vehicles"] = f"""SELECT vehicle_type, {VEHICLES} AS vehicles FROM over
        GROUP BY 1"""
    o["m_fuel_records"] = _fuel_measure("count(*)", "fuel_records")
    o["m_vehicles_with_fuel"] = _fuel_measure("count(DISTINCT skey)", "vehicles_with_fuel")
    o["m_avg_co2"] = _fuel_measure("avg(co2)", "avg_co2")
    o["m_avg_power"] = _fuel_measure("avg(kw)", "avg_power")
    o["m_co2_coverage"] = _fuel_measure("count(co2) / count(*)", "co2_coverage")
    o["m_power_coverage"] = _fuel_measure("count(kw) / count(*)", "power_coverage")
    o["m_multi_fuel"] = f"""SELECT powertrain_category, vehicle_type,
        {MULTI} AS multi_fuel_vehicles FROM over GROUP BY 1, 2"""
    o["m_multi_fuel_share"] = f"""SELECT powertrain_category,
        {MULTI} / {VEHICLES} AS multi_fuel_share FROM over GROUP BY 1"""
    o["m_powertrain_share"] = f"""SELECT vehicle_type, powertrain_category, vehicles,
            vehicles / whole AS share
        FROM (SELECT vehicle_type, powertrain_category, {VEHICLES} AS vehicles,
                     sum({VEHICLES}) OVER (PARTITION BY vehicle_type) AS whole
              FROM over GROUP BY 1, 2)
        WHERE powertrain_category IN ('Battery electric', 'Hybrid electric')"""
    o["m_snapshot_started"] = """SELECT powertrain_category,
        max(snapshot_started_at) AS snapshot_started_at FROM over GROUP BY 1"""
    o["rel_filter"] = """SELECT skey AS vehicle_snapshot_key, vid AS vehicle_key,
            seq AS fuel_sequence, ftype AS fuel_type
        FROM ff WHERE cat = 'Hybrid electric'"""
    o["slicer"] = """SELECT * EXCLUDE (snapshot_started_at) FROM over
        WHERE brand IN ('NATION_1', 'NATION_2', 'NATION_12')
          AND vehicle_type IN ('F', 'O') AND registration_year IN (1996, 1999)"""
    calendar = """CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_no,
        strftime(d, '%B') AS month, CAST(quarter(d) AS INTEGER) AS quarter_no,
        'Qtr ' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(day(d) AS INTEGER) AS day"""
    o["calendar_dim"] = f"""SELECT d AS date, {calendar}
        FROM (SELECT CAST(unnest(generate_series(
                  make_date(CAST(min(year(rdate)) AS BIGINT), 1, 1),
                  make_date(CAST(max(year(rdate)) AS BIGINT), 12, 31),
                  INTERVAL 1 DAY)) AS DATE) AS d FROM veh)"""
    o["date_hierarchy"] = """SELECT y AS year, q AS quarter, m AS month, d AS day,
            CAST(grouping_id(y, q, m, d) AS INTEGER) AS level, count(*) AS vehicles
        FROM (SELECT CAST(year(rdate) AS INTEGER) AS y, CAST(quarter(rdate) AS INTEGER) AS q,
                     CAST(month(rdate) AS INTEGER) AS m, CAST(day(rdate) AS INTEGER) AS d
              FROM snap) GROUP BY ROLLUP (y, q, m, d)"""
    o["date_part_join"] = """SELECT CAST(ts AS DATE) AS date,
            'Qtr ' || CAST(quarter(ts) AS VARCHAR) AS quarter, count(*) AS rows
        FROM events GROUP BY 1, 2"""
    # --- models ---
    o["dim_vehicle"] = """SELECT vid AS vehicle_key, colour AS primary_colour,
        CAST(NULL AS VARCHAR) AS secondary_colour FROM veh"""
    o["dim_vehicle_model"] = """SELECT DISTINCT md5(concat_ws('|',
            coalesce(brand, '<unknown>'), coalesce(model, '<unknown>'),
            coalesce(vtype, '<unknown>'))) AS vehicle_model_key,
            brand, model, vtype AS vehicle_type FROM veh"""
    o["dim_registration_date"] = """SELECT DISTINCT
            CAST(strftime(rdate, '%Y%m%d') AS INTEGER) AS registration_date_key,
            rdate AS registration_date, CAST(year(rdate) AS INTEGER) AS registration_year,
            CAST(month(rdate) AS INTEGER) AS registration_month,
            CAST(quarter(rdate) AS INTEGER) AS registration_quarter
        FROM veh WHERE rdate IS NOT NULL"""
    o["dim_powertrain"] = """SELECT DISTINCT md5(concat_ws('|', cat, e, h, o))
            AS powertrain_key, cat AS powertrain_category, e AS has_electric,
            h AS has_hydrogen, o AS has_other_fuel FROM cat"""
    o["fact_vehicle_snapshot"] = """SELECT skey AS vehicle_snapshot_key, vid AS vehicle_key,
            mkey AS vehicle_model_key, dkey AS registration_date_key,
            pkey AS powertrain_key, run AS snapshot_ingestion_id,
            started_at AS snapshot_started_at, n AS fuel_record_count, 1 AS vehicle_count
        FROM snap"""
    o["fact_vehicle_fuel"] = """SELECT fkey AS vehicle_fuel_fact_key,
            skey AS vehicle_snapshot_key, vid AS vehicle_key, run AS snapshot_ingestion_id,
            seq AS fuel_sequence, ftype AS fuel_type, emission AS emission_code,
            co2 AS co2_combined_g_km, kw AS net_max_power_kw, hybrid AS hybrid_class
        FROM ff"""
    o["mart_ev_overview"] = "SELECT * FROM over"
    o["mart_ev_metrics"] = "SELECT * FROM met"
    o["star_overview"] = o["mart_ev_overview"]
    o["star_metrics"] = o["mart_ev_metrics"]
    o["stg_vehicles"] = """SELECT vid AS vehicle_id_hash, brand, model,
            rdate AS registration_date, ryear AS registration_year,
            colour AS primary_colour, CAST(NULL AS VARCHAR) AS secondary_colour,
            vtype AS vehicle_type, run AS ingestion_id FROM veh"""
    o["stg_fuels"] = f"SELECT {STAGED_FUEL}, run AS ingestion_id FROM fur"
    o["stg_ingestion_runs"] = """SELECT ingestion_id, started_at, ingestion_mode,
            requested_limit, page_size, pages_requested AS api_requests,
            source_rows_received, matched_vehicles, CAST(fuel_rows AS BIGINT) AS fuel_rows,
            rejected_rows, resumed, resume_count FROM runs"""
    o["int_vehicle_fuel_profile"] = """SELECT vid AS vehicle_id_hash,
            n AS fuel_record_count, e AS has_electric, h AS has_hydrogen,
            o AS has_other_fuel, cat AS powertrain_category FROM cat"""
    o["int_snapshot_context"] = """SELECT DISTINCT run AS ingestion_id,
            started_at AS snapshot_started_at, ingestion_mode, requested_limit, page_size,
            pages_requested AS api_requests, source_rows_received, resumed, resume_count
        FROM veh LEFT JOIN runs ON ingestion_id = run"""
    o["md5_key"] = """SELECT md5(run || '|' || vid || '|' || CAST(seq AS VARCHAR))
            AS fact_key, md5(vid || '|' || hybrid) AS null_key FROM fur"""
    o["md5_key_nullsafe"] = """SELECT vid AS vehicle_id_hash, seq AS fuel_sequence,
            md5(coalesce(ftype, '<unknown>') || '|' || coalesce(emission, '<unknown>')
                || '|' || coalesce(hybrid, '<unknown>')) AS type_key FROM fu"""
    o["md5_key_flags"] = """SELECT vid AS vehicle_id_hash, md5(cat || '|'
            || CAST(e AS VARCHAR) || '|' || CAST(h AS VARCHAR) || '|'
            || CAST(o AS VARCHAR)) AS powertrain_key FROM cat"""
    o["date_key"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0
            THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS date_key
        FROM orders"""
    # --- data tests ---
    o["dq_not_null"] = """SELECT vid AS vehicle_id_hash, seq AS fuel_sequence
        FROM fu WHERE emission IS NULL"""
    o["dq_unique"] = """SELECT o_custkey, count(*) AS rows FROM orders
        GROUP BY 1 HAVING count(*) > 1"""
    o["dq_unique_expr"] = """SELECT CAST(l_orderkey AS VARCHAR) || ':'
            || CAST(l_linenumber AS VARCHAR) AS line_key, count(*) AS rows
        FROM lineitem GROUP BY 1 HAVING count(*) > 1"""
    o["dq_relationship"] = """SELECT vid AS vehicle_id_hash, count(*) AS rows FROM fu
        WHERE vid NOT IN (SELECT vid FROM cat) GROUP BY 1"""
    o["dq_accepted_values"] = """SELECT ftype AS fuel_type, count(*) AS rows FROM fu
        WHERE ftype NOT IN ('Elektriciteit', 'Waterstof', 'Benzine') GROUP BY 1"""
    grains = {
        "dim_vehicle": "SELECT vid FROM snap",
        "dim_registration_date": "SELECT DISTINCT rdate FROM snap",
        "dim_vehicle_model": "SELECT DISTINCT brand, model, vtype FROM snap",
        "dim_powertrain": "SELECT DISTINCT cat, e, h, o FROM snap",
        "mart_ev_overview": "SELECT skey FROM snap",
    }
    o["dq_grain_reconcile"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS model_name, count(*) AS expected_rows,
            count(*) AS actual_rows FROM ({rows})"""
        for name, rows in grains.items()
    )
    o["dq_fact_fuel_rowcount"] = """SELECT (SELECT count(*) FROM fu) AS staging_rows,
            (SELECT count(*) FROM ff) AS fact_rows
        WHERE (SELECT count(*) FROM fu) <> (SELECT count(*) FROM ff)"""
    o["dq_fact_snapshot_rowcount"] = """SELECT (SELECT count(*) FROM veh) AS staging_rows,
            (SELECT count(*) FROM snap) AS fact_rows
        WHERE (SELECT count(*) FROM veh) <> (SELECT count(*) FROM snap)"""
    o["dq_mart_recompute_diff"] = """SELECT *, '' AS side, CAST(0 AS BIGINT) AS copies
        FROM met WHERE vehicle_count < 0"""
    o["dq_mart_recompute_drift"] = """SELECT *, 'expected' AS side, CAST(1 AS BIGINT) AS copies
            FROM met WHERE brand = 'NATION_1'
        UNION ALL SELECT *, 'actual', 1 FROM met WHERE brand = 'NATION_2'"""
    o["dq_no_plaintext_columns"] = """SELECT 'raw_fuels' AS relation,
        'kenteken' AS column_name, count(*) AS rows FROM rawf"""
    o["dq_nonnegative_measures"] = """
        SELECT 'fact_vehicle_fuel.co2_combined_g_km' AS failing_measure FROM fu
               WHERE co2 < 0
        UNION ALL SELECT 'fact_vehicle_fuel.net_max_power_kw' FROM fu WHERE kw < 0
        UNION ALL SELECT 'fact_vehicle_snapshot.fuel_record_count' FROM cat WHERE n < 1
        UNION ALL SELECT 'customer.c_acctbal' FROM customer WHERE c_acctbal < 0"""
    o["dq_classification"] = """SELECT vid AS vehicle_id_hash, n AS fuel_record_count,
            e AS has_electric, h AS has_hydrogen, o AS has_other_fuel,
            'Battery electric' AS powertrain_category
        FROM cat WHERE n > 5 AND cat <> 'Battery electric'"""
    o["dq_date_range"] = """SELECT registration_date FROM (
            SELECT CAST(CASE WHEN o_orderpriority = '1-URGENT'
                             THEN CAST(o_orderdate AS DATE) - INTERVAL 99 YEAR
                             ELSE o_orderdate END AS DATE) AS registration_date FROM orders)
        WHERE registration_date < DATE '1900-01-01'
           OR registration_date > current_date + INTERVAL 1 YEAR"""
    o["staging_gate"] = "SELECT * FROM gate"
    for key, check in {
        "gate_null_keys": "null_vehicle_hashes",
        "gate_duplicate_keys": "duplicate_vehicles",
        "gate_orphans": "orphan_fuels",
        "gate_bad_hash": "invalid_vehicle_hashes",
        "gate_year_range": "invalid_registration_years",
        "gate_empty": "empty_vehicle_staging",
    }.items():
        o[key] = _gate(check)
    o["gate_plain_columns"] = """SELECT "check", CAST(1 AS BIGINT) AS violations FROM gate
        WHERE "check" = 'plain_identifier_columns'"""
    o["scan_patterns"] = _scan({**AUDIT_PATTERNS, **DOCUMENT_PATTERNS})
    o["scan_plaintext_values"] = """SELECT 'leaky_lines' AS relation, 'note' AS "column",
            count(*) AS rows
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)"""
    o["scan_paths"] = """SELECT doc_id, path FROM (
            SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'x/data/' ELSE 'x/metadata/' END
                || source || ['.md', '.parquet', '.LOG', '.py', '/.env'][doc_id % 5 + 1] AS path
            FROM documents)
        WHERE path LIKE '%/data/%' OR path LIKE '%.parquet' OR path ILIKE '%.log'
           OR path LIKE '%/.env'"""
    o["verify_expected"] = """SELECT 'lineitem' AS finding, count(*) AS violations
        FROM lineitem UNION ALL SELECT 'filled_fuels', 1"""
    # --- joins ---
    o["join_inner_one_key"] = """SELECT vid AS vehicle_id_hash, vtype AS vehicle_type,
        n AS fuel_record_count FROM snap"""
    o["join_inner_two_keys"] = """SELECT f.vid AS vehicle_id_hash, f.run AS ingestion_id,
            seq AS fuel_sequence, rdate AS registration_date
        FROM fur AS f JOIN veh AS v ON f.vid = v.vid AND f.run = v.run"""
    o["join_left"] = """SELECT veh.vid AS vehicle_id_hash, cat AS powertrain_category
        FROM veh LEFT JOIN cat ON veh.vid = cat.vid"""
    o["join_anti"] = """SELECT vid AS vehicle_id_hash, run AS ingestion_id FROM veh
        WHERE vid NOT IN (SELECT vid FROM fu)"""
    o["join_semi"] = """SELECT vid AS vehicle_id_hash, run AS ingestion_id FROM veh
        WHERE vid IN (SELECT vid FROM fu)"""
    o["join_semi_topn"] = f"""SELECT vehicle_snapshot_key, brand, vehicle_count FROM over
        WHERE brand IN (SELECT brand FROM ({brands}10))"""
    o["join_exists_probe"] = """SELECT o_orderkey, o_orderkey IN (
            SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS duplicate
        FROM orders"""
    o["join_count_pair"] = """SELECT 'orders' AS model_name,
        (SELECT count(*) FROM orders) AS expected_rows,
        (SELECT count(*) FROM lineitem) AS actual_rows"""
    # --- aggregations ---
    o["agg_global"] = """SELECT count(*) AS rows, count(co2) AS co2_rows,
        count(DISTINCT vid) AS vehicles, avg(co2) AS avg_co2, sum(kw) AS sum_power,
        min(kw) AS min_power, max(kw) AS max_power FROM fu"""
    o["agg_group_two_keys"] = """SELECT ftype AS fuel_type, hybrid AS hybrid_class,
        count(*) AS rows, avg(kw) AS avg_power FROM fu GROUP BY 1, 2"""
    o["agg_bool_or"] = """SELECT l_suppkey,
            bool_or(CASE WHEN l_linestatus = 'F' THEN l_returnflag END = 'A') AS any_a,
            bool_or(CASE WHEN l_linestatus = 'F' THEN l_returnflag END = 'N') AS any_n
        FROM lineitem GROUP BY 1"""
    o["agg_having"] = """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1"""
    o["agg_rollup_hierarchy"] = f"""SELECT brand, model,
            CAST(grouping_id(brand, model) AS INTEGER) AS level, {VEHICLES} AS vehicles
        FROM over GROUP BY ROLLUP (brand, model)"""
    o["agg_group_as_distinct"] = """SELECT l_returnflag, l_linestatus FROM lineitem
        GROUP BY 1, 2"""
    # --- sorts, limits, sets ---
    o["sort_multi_key"] = f"""SELECT registration_year, vehicle_type,
        {VEHICLES} AS vehicles FROM over GROUP BY 1, 2"""
    o["topk_rows"] = """SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 50"""
    o["topn_with_ties"] = """SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1
        QUALIFY rank() OVER (ORDER BY count(*) DESC) <= 10"""
    o["distinct_rows"] = """SELECT DISTINCT ftype AS fuel_type, emission AS emission_code,
        hybrid AS hybrid_class FROM fu"""
    o["union_all"] = """SELECT o_orderkey AS key, 'order' AS kind FROM orders
        UNION ALL SELECT l_orderkey, 'line' FROM lineitem"""
    o["except_all_both_ways"] = """SELECT l_orderkey, l_linenumber, 'expected' AS side,
            count(*) AS copies
        FROM (SELECT l_orderkey, l_linenumber FROM lineitem
              EXCEPT ALL SELECT l_orderkey, l_linenumber FROM line1) GROUP BY 1, 2"""
    o["intersect_ids"] = """SELECT o_orderkey AS key FROM orders
        INTERSECT SELECT l_orderkey FROM lineitem"""
    o["set_difference"] = """SELECT o_orderkey AS key FROM orders
        EXCEPT SELECT l_orderkey FROM lineitem"""
    # --- scalars ---
    o["scalar_text"] = """SELECT c_custkey, lower(c_mktsegment) AS lowered,
            upper(c_name) AS uppered, c_mktsegment AS trimmed,
            CAST(length(c_mktsegment) + 3 AS INTEGER) AS len,
            CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS blank_to_null,
            CASE WHEN c_mktsegment = 'BUILDING' THEN '-' ELSE c_mktsegment END AS coalesced,
            CASE WHEN c_custkey % 2 = 0 THEN c_name || '!' END AS null_concat,
            NOT regexp_matches(c_mktsegment, '^[A-F]') AS not_matching,
            c_mktsegment IN ('BUILDING', 'MACHINERY') AS listed
        FROM customer"""
    o["scalar_dates"] = f"""SELECT o_orderkey, strftime(d, '%Y%m%d') AS compact, {calendar},
            CAST(d + INTERVAL 1 YEAR AS DATE) AS next_year, d < DATE '1998-01-01' AS early
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""
    o["scalar_numbers"] = """SELECT c_custkey, round(c_acctbal / 7 * 100) / 100 AS rounded,
            c_acctbal / nullif(c_nationkey, 0) AS divided,
            CASE WHEN c_acctbal > 0 THEN 'credit' END AS side,
            greatest(0.0, c_acctbal) AS floored
        FROM customer"""
    # --- normalisation ---
    hash_raw = f"sha256('{SALT}:' || id) AS vehicle_id_hash"
    o["normalize_vehicles"] = f"""SELECT {hash_raw}, upper(brand) AS brand, model,
            rdate AS registration_date, CAST(year(rdate) AS INTEGER) AS registration_year,
            upper(colour) AS primary_colour, CAST(NULL AS VARCHAR) AS secondary_colour,
            vtype AS vehicle_type, 'run_x' AS ingestion_id
        FROM rawv WHERE id <> ''"""
    o["normalize_fuels"] = f"""SELECT {hash_raw}, seq AS fuel_sequence,
            coalesce(ftype, 'Unknown') AS fuel_type, emission AS emission_code,
            co2 AS co2_combined_g_km, kw AS net_max_power_kw, hybrid AS hybrid_class,
            'run_x' AS ingestion_id
        FROM rawf WHERE id <> ''"""
    o["salted_sha256"] = "SELECT o_orderkey, vid AS vehicle_id_hash FROM veh"
    o["drop_blank_id"] = """SELECT id, seq_text AS brandstof_volgnummer FROM rawf
        WHERE id <> ''"""
    o["clean_upper"] = "SELECT upper(brand) AS brand, model FROM rawv"
    o["clean_text"] = "SELECT emission AS c0, ftype AS c1 FROM rawf"
    o["default_text"] = "SELECT coalesce(ftype, 'Unknown') AS c0 FROM rawf"
    o["parse_compact_date"] = "SELECT id, rdate AS registration_date FROM rawv"
    o["parse_decimal_comma"] = "SELECT co2 AS c0, kw AS c1 FROM rawf"
    o["parse_int_default"] = "SELECT seq AS c0 FROM rawf"
    o["derive_year"] = """SELECT id, CAST(year(rdate) AS INTEGER) AS registration_year
        FROM rawv"""
    o["stamp_lineage"] = "SELECT o_orderkey, run AS ingestion_id FROM veh"
    # --- upsert and staging ---
    o["upsert_by_key_one"] = """SELECT vid AS vehicle_id_hash,
            CASE WHEN vid IN (SELECT vid FROM cat) THEN vtype ELSE 'old' END
                AS vehicle_type, run AS ingestion_id FROM veh"""
    o["upsert_by_key_two"] = """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
        WHERE l_returnflag = 'R'
        UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM line1
        WHERE NOT EXISTS (SELECT 1 FROM lineitem AS i WHERE i.l_returnflag = 'R'
            AND i.l_orderkey = line1.l_orderkey AND i.l_linenumber = line1.l_linenumber)"""
    o["resolve_latest"] = """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        QUALIFY rank() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY year(l_shipdate) DESC) = 1"""
    o["upsert_empty_guard"] = "SELECT count(*) AS rows FROM rawv WHERE id <> ''"
    o["page_transaction"] = """SELECT 'vehicles' AS relation, count(*) AS rows FROM veh
        UNION ALL SELECT 'fuels', count(*) FROM fur"""
    o["replace_snapshot"] = """SELECT vid AS vehicle_id_hash, rdate AS registration_date,
            ryear AS registration_year, colour AS primary_colour,
            CAST(NULL AS VARCHAR) AS secondary_colour, vtype AS vehicle_type,
            run AS ingestion_id
        FROM veh WHERE vtype = 'F'"""
    o["schema_gate"] = """
        SELECT 'vehicles' AS relation, 0 AS problems, count(*) AS rows FROM veh
        UNION ALL SELECT 'fuels', 0, count(*) FROM fur
        UNION ALL SELECT 'broken', 8, count(*) FROM lineitem"""
    # --- page assembly ---
    o["keyset_page"] = """SELECT id AS kenteken FROM anch WHERE id > '5'
        ORDER BY id LIMIT 1000"""
    o["keyset_page_all"] = "SELECT id AS kenteken, page, pos FROM apage"
    o["batch_assign"] = """SELECT id AS kenteken,
            CAST((row_number() OVER (ORDER BY id) - 1) // 200 AS BIGINT) AS batch
        FROM (SELECT DISTINCT id FROM rawf WHERE id <> '')"""
    o["detail_lookup"] = """SELECT CAST(l_orderkey AS VARCHAR) AS kenteken,
            seq AS l_linenumber, l_returnflag FROM fu
        WHERE CAST(l_orderkey AS VARCHAR) IN (SELECT id FROM apage WHERE page = 0)"""
    o["offset_page"] = """SELECT o_orderkey, o_orderdate FROM orders
        ORDER BY o_orderdate, o_orderkey LIMIT 200 OFFSET 500"""
    o["offset_page_deep"] = """SELECT l_orderkey, l_linenumber, l_shipdate FROM line1
        ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 1000 OFFSET 3000"""
    o["snapshot_cap"] = "SELECT vid AS vehicle_id_hash FROM cat ORDER BY vid LIMIT 10000"
    o["page_order_guard"] = """SELECT page, pos, id, prev_id,
            CASE WHEN pos = 0 THEN 'not_advanced' ELSE 'not_increasing' END AS violation
        FROM (SELECT CAST(o_orderkey // 1000 AS BIGINT) AS page,
                     CAST(o_orderkey % 1000 AS BIGINT) AS pos,
                     CAST(o_orderkey AS VARCHAR) AS id,
                     lag(CAST(o_orderkey AS VARCHAR)) OVER (ORDER BY o_orderkey) AS prev_id
              FROM orders WHERE o_orderkey // 1000 % 7 <> 3) WHERE id <= prev_id"""
    o["page_order_guard_clean"] = """SELECT page, pos, id, id AS prev_id, '' AS violation
        FROM apage WHERE page < 0"""
    o["complete_ids"] = "SELECT page, id AS kenteken FROM idstate WHERE complete"
    o["complete_rows"] = """SELECT id AS kenteken, seq_text AS brandstof_volgnummer
        FROM rawf WHERE id IN (SELECT id FROM idstate WHERE complete)"""
    o["page_counters"] = """SELECT *, 'r' AS run,
            CAST(sum(source_rows) OVER w AS BIGINT) AS total_source_rows,
            CAST(sum(matched) OVER w AS BIGINT) AS total_matched,
            CAST(sum(fuel_rows) OVER w AS BIGINT) AS total_fuel_rows,
            CAST(sum(rejected) OVER w AS BIGINT) AS total_rejected
        FROM counters WINDOW w AS (ORDER BY page ROWS UNBOUNDED PRECEDING)"""
    o["rejection_count"] = """SELECT CAST(sum(rejected) AS BIGINT) AS rejected_rows,
        CAST(sum(matched) AS BIGINT) AS matched_vehicles FROM counters"""
    o["page_digest"] = """SELECT 'orders' AS dataset, page,
        CAST(row_count AS INTEGER) AS row_count, digest AS payload_sha256 FROM odigest"""
    o["land_raw_page"] = """SELECT 'orders' AS dataset, page, digest, false AS duplicate
        FROM odigest"""
    o["raw_integrity_scan"] = """SELECT digest, page <> 0 AS ok FROM odigest
        UNION ALL SELECT digest, false FROM odigest WHERE page = 0"""
    o["scan_raw_pages"] = """SELECT page, pos, k AS o_orderkey, s AS o_orderstatus,
        p AS o_orderpriority FROM opage"""
    o["scan_raw_json"] = """SELECT pos, k AS o_orderkey, s AS o_orderstatus,
        p AS o_orderpriority FROM opage"""
    o["payload_ledger_insert"] = """SELECT doc_id, lang AS dataset,
        digest AS payload_sha256, dup AS duplicate FROM arrive"""
    o["payload_ledger_table"] = """SELECT lang AS dataset, digest AS payload_sha256,
            'known' AS raw_path, n AS row_count, 'run_0' AS first_ingestion_id FROM known
        UNION ALL SELECT lang, digest, 'doc/' || CAST(doc_id AS VARCHAR), n_chars,
            'run_' || source FROM arrive WHERE NOT dup"""
    o["duplicate_payload_count"] = """SELECT 'run_' || source AS first_ingestion_id,
        count(*) FILTER (dup) AS duplicate_payloads FROM arrive GROUP BY 1"""
    o["resume_cursor"] = "SELECT max(id) AS cursor FROM apage WHERE page < 5"
    # --- runs ---
    o["run_metrics"] = """SELECT ingestion_id,
            matched_vehicles + fuel_rows AS processed_rows,
            round(active_duration_seconds, 3) AS active_duration_seconds,
            CAST(date_diff('second', started_at, completed_at) AS DOUBLE)
                AS wall_clock_elapsed_seconds,
            round(processed_rows_per_second, 3) AS processed_rows_per_second FROM runs"""
    o["run_upsert"] = """SELECT ingestion_id, CASE WHEN resumed
            THEN 'interrupted' ELSE status END AS status, vehicle_rows FROM runs
        UNION ALL SELECT 'new_' || ingestion_id, 'running', vehicle_rows FROM runs
            WHERE resumed"""
    o["run_schema_evolve"] = """SELECT ingestion_id,
            CASE WHEN odd THEN 'resumable_snapshot' ELSE 'legacy_sample' END
                AS ingestion_mode,
            CAST(nullif(sample_limit, 0) AS BIGINT) AS requested_limit,
            CASE WHEN odd THEN 1.5 ELSE active_duration_seconds END::DOUBLE
                AS active_duration_seconds,
            processed_rows_per_second, false AS resumed,
            0 AS resume_count, CAST(0 AS BIGINT) AS matched_vehicles
        FROM (SELECT *, CAST(right(ingestion_id, 4) AS INTEGER) % 2 = 1 AS odd FROM runs)"""
    # --- sources and sinks ---
    o["scan_staging"] = """SELECT 'vehicles' AS relation, count(*) AS rows FROM veh
        UNION ALL SELECT 'fuels', count(*) FROM fur
        UNION ALL SELECT 'ingestion_runs', count(*) FROM runs"""
    o["projected_source_scan"] = "SELECT l_orderkey, l_returnflag FROM lineitem"
    o["filtered_source_scan"] = """SELECT l_orderkey, l_linenumber, l_returnflag
        FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_orderkey > 1000"""
    cells = [
        *[("vehicles", c, e, t, "veh") for c, (e, t) in {
            "vehicle_id_hash": ("vid", "string"), "brand": ("brand", "string"),
            "model": ("model", "string"), "registration_date": ("rdate", "date"),
            "registration_year": ("ryear", "int"), "primary_colour": ("colour", "string"),
            "secondary_colour": ("NULL", "string"), "vehicle_type": ("vtype", "string"),
            "ingestion_id": ("run", "string"),
        }.items()],
        *[("fuels", c, e, t, "fur") for c, (e, t) in {
            "vehicle_id_hash": ("vid", "string"), "fuel_sequence": ("seq", "int"),
            "fuel_type": ("ftype", "string"), "emission_code": ("emission", "string"),
            "co2_combined_g_km": ("co2", "double"), "net_max_power_kw": ("kw", "double"),
            "hybrid_class": ("hybrid", "string"), "ingestion_id": ("run", "string"),
        }.items()],
    ]
    o["catalog_scan"] = "\nUNION ALL ".join(
        f"SELECT '{t}' AS relation, '{c}' AS column_name, '{kind}' AS data_type, count({e}) AS n"
        f" FROM {src}"
        for t, c, e, kind, src in cells
    )
    o["write_zstd_parquet"] = o["mart_ev_metrics"]
    o["describe_parquet"] = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n FROM met"
        for c in (
            "fuel_type", "brand", "model", "registration_year", "powertrain_category",
            "vehicle_count", "avg_reported_co2_combined_g_km",
            "avg_reported_net_max_power_kw",
        )
    )
    inventory = {
        **grains,
        "fact_vehicle_fuel": "SELECT fkey FROM ff",
        "fact_vehicle_snapshot": "SELECT skey FROM snap",
        "mart_ev_metrics": "SELECT vehicle_count FROM met",
    }
    o["output_inventory"] = " UNION ALL ".join(
        f"SELECT '{name}' AS relation, count(*) AS rows FROM ({rows})"
        for name, rows in inventory.items()
    )
    o["publish_set"] = o["output_inventory"]
    o["scan_published_parquet"] = o["mart_ev_overview"]
    # --- model tests ---
    o["dq_model_contracts"] = _contract_sql(o)
    o["dq_singular_tests"] = f"""
        SELECT 'grain_reconcile' AS "check", CAST(0 AS BIGINT) AS violations
        UNION ALL SELECT 'fact_fuel_rowcount', count(*) FROM ({o["dq_fact_fuel_rowcount"]})
        UNION ALL SELECT 'fact_snapshot_rowcount', count(*)
               FROM ({o["dq_fact_snapshot_rowcount"]})
        UNION ALL SELECT 'mart_recompute_diff', count(*) FROM ({o["dq_mart_recompute_diff"]})
        UNION ALL SELECT 'nonnegative_measures', count(*) FROM fu WHERE co2 < 0 OR kw < 0
        UNION ALL SELECT 'classification', count(*) FROM cat WHERE cat IS NULL
        UNION ALL SELECT 'date_range', count(DISTINCT rdate) FROM veh
               WHERE rdate < DATE '1900-01-01' OR rdate > current_date + INTERVAL 1 YEAR
        UNION ALL SELECT 'no_plaintext_columns', 0"""
    # --- streaming: the settled log equals the batch result ---
    complete = f"""SELECT sha256('{SALT}:' || id) AS vehicle_id_hash FROM anch
        WHERE id IN (SELECT id FROM rawv) AND id IN (SELECT id FROM rawf)"""
    o["stream_page_ingest"] = f"""SELECT * FROM ({o['normalize_fuels']})
        WHERE vehicle_id_hash IN ({complete})"""
    o["stream_bounded_page"] = f"""SELECT * FROM ({o['normalize_vehicles']})
        WHERE vehicle_id_hash IN ({complete})"""
    o["stream_second_snapshot"] = f"""SELECT * FROM ({o['normalize_vehicles']})
        WHERE vehicle_id_hash IN (SELECT sha256('{SALT}:' || id) FROM apage
            WHERE page = 0 AND id IN (SELECT id FROM rawv) AND id IN (SELECT id FROM rawf))"""
    o["stream_rerun"] = f"""SELECT 'vehicles' AS relation, count(*) AS rows
            FROM ({o['stream_bounded_page']})
        UNION ALL SELECT 'fuels', count(*) FROM ({o['stream_page_ingest']})
        UNION ALL SELECT 'new_payloads', 0 UNION ALL SELECT 'pages_not_duplicate', 0"""
    anchored = "(SELECT l_orderkey FROM line1 WHERE l_returnflag IN ('A', 'N'))"
    fueled = f"SELECT * FROM line1 WHERE l_orderkey IN {anchored}"
    o["snapshot_job"] = f"""SELECT * FROM (
        WITH v AS (SELECT o_orderkey, n_name, c_mktsegment, o_orderdate FROM orders
                LEFT JOIN customer ON o_custkey = c_custkey
                LEFT JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey IN {anchored}),
            f AS ({fueled})
        SELECT 'matched_vehicles' AS name, count(*) AS rows FROM v
        UNION ALL SELECT 'fuel_rows', count(*) FROM f
        UNION ALL SELECT 'source_rows_received', 2 * (SELECT count(*) FROM v) + count(*) FROM f
        UNION ALL SELECT 'rejected_rows', 0
        UNION ALL SELECT 'dim_vehicle', count(*) FROM v
        UNION ALL SELECT 'fact_vehicle_snapshot', count(*) FROM v
        UNION ALL SELECT 'fact_vehicle_fuel', count(*) FROM f
        UNION ALL SELECT 'mart_ev_overview', count(*) FROM v)"""
    o["snapshot_job_resumed"] = f"""{o['snapshot_job']}
        UNION ALL SELECT 'resume_count', 1"""
    o["snapshot_job_limit"] = f"""SELECT sha256('{SALT}:' || CAST(o_orderkey AS VARCHAR)) AS vehicle_id_hash
        FROM orders WHERE o_orderkey IN {anchored} ORDER BY CAST(o_orderkey AS VARCHAR) LIMIT 500"""
    o["run_cursor"] = """SELECT max(id) AS cursor FROM apage
        WHERE page < (SELECT (max(page) + 1) // 2 FROM apage)"""
    o["verify_run"] = "SELECT digest FROM odigest WHERE page = 2"
    o["stream_page_counters"] = """SELECT CAST(a.page AS BIGINT) AS page,
            CAST(sum(1 + coalesce(v.n, 0) + coalesce(f.n, 0)) AS BIGINT) AS source_rows,
            CAST(coalesce(sum(v.n) FILTER (f.n IS NOT NULL), 0) AS BIGINT) AS matched,
            CAST(coalesce(sum(f.n) FILTER (v.n IS NOT NULL), 0) AS BIGINT) AS fuel_rows,
            count(*) FILTER (v.n IS NULL OR f.n IS NULL) AS rejected
        FROM apage a LEFT JOIN (SELECT id, count(*) AS n FROM rawv GROUP BY id) v ON v.id = a.id
        LEFT JOIN (SELECT id, count(*) AS n FROM rawf GROUP BY id) f ON f.id = a.id GROUP BY a.page"""
    o["mart_ev_metrics_maintained"] = o["mart_ev_metrics"]
    o["except_all_by_bucket"] = o["except_all_both_ways"]
    o["upsert_buckets"] = """SELECT l_orderkey, l_linenumber, l_returnflag FROM line1
            WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber)
                FROM lineitem WHERE l_orderkey % 1000 = 0)
        UNION ALL SELECT l_orderkey, l_linenumber, 'U' FROM lineitem WHERE l_orderkey % 1000 = 0"""
    o["upsert_buckets_untouched"] = "SELECT true AS some_untouched, 0 AS changed"
    return {name: _with(body) for name, body in o.items()}


ORACLE = _sql()
