"""Independent SQL statements (DuckDB dialect) of the stand-in star schema and the views.

Used only as the correctness oracle: DuckDB evaluates them on the same parquet
tables and the results are compared with the Spark operators. DuckDB has no
``initcap``; ``tc()`` spells the same rule out (split on spaces, upper first letter,
lower the rest).
"""

from __future__ import annotations


def tc(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def short(expr: str) -> str:
    """First letter + '. ' + last word; '' as last word when there is no space."""
    return (f"(left({expr}, 1) || '. ' || CASE WHEN strpos({expr}, ' ') = 0 THEN '' "
            f"ELSE reverse(left(reverse({expr}), strpos(reverse({expr}), ' ') - 1)) END)")


GOLD = f"""
fact_sessions AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS round,
         CASE WHEN l_linestatus = 'F' THEN 'RACE' ELSE 'SPRINT' END AS session_type,
         o_custkey AS driver_id, min(l_suppkey) AS constructor_id, sum(l_quantity) AS points,
         min(l_partkey) AS min_part, min(l_returnflag) AS min_flag, CAST(count(*) AS INTEGER) AS completed_laps
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2, 3, 4),
fact_positions AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY season, round, session_type ORDER BY points DESC, driver_id) AS INTEGER)
      AS final_position,
    CAST(row_number() OVER (PARTITION BY season, round, session_type ORDER BY min_part, driver_id) AS INTEGER)
      AS grid_position
  FROM fact_sessions),
fact AS (
  SELECT season, round, constructor_id, driver_id, grid_position, completed_laps,
         CAST(driver_id % 100 AS INTEGER) AS car_number, points, final_position,
         CAST(final_position AS VARCHAR) AS final_position_text,
         CASE min_flag WHEN 'A' THEN 'Finished' WHEN 'N' THEN '+1 Lap' ELSE 'Engine' END AS status,
         session_type,
         final_position = 1 AS is_win, final_position BETWEEN 1 AND 3 AS is_podium,
         points > 0 AS has_points, grid_position = 1 AS is_pole
  FROM fact_positions),
ref_region AS (
  SELECT {tc('n_name')} AS nationality, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_drivers AS (
  SELECT c_custkey AS driver_id, {tc("concat_ws(' ', lower(c_mktsegment), lower(c_name))")} AS driver_name,
         DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS date_of_birth,
         {tc('n_name')} AS nationality, rr.region AS nationality_region
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN ref_region rr ON rr.nationality = {tc('n_name')}),
dim_constructors AS (
  SELECT s_suppkey AS constructor_id,
         concat_ws(' ', {tc('s_name')}, CASE WHEN s_suppkey % 2 = 0 THEN 'Team' END) AS constructor_name,
         {tc('n_name')} AS nationality, rr.region AS nationality_region
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
       LEFT JOIN ref_region rr ON rr.nationality = {tc('n_name')}),
dim_races AS (
  SELECT CAST(m.season AS INTEGER) AS season, CAST(m.round AS INTEGER) AS round,
         strftime(m.race_date, '%B') || ' Grand Prix' AS race_name, m.race_date,
         {tc('n_name')} || ' Circuit' AS circuit_name, {tc('r_name')} AS locality, n_name AS country
  FROM (SELECT year(o_orderdate) AS season, month(o_orderdate) AS round,
               min(CAST(o_orderdate AS DATE)) AS race_date
        FROM orders GROUP BY 1, 2) m
       JOIN nation ON n_nationkey = (m.season * 12 + m.round) % 25
       JOIN region ON n_regionkey = r_regionkey),
ref_color AS (
  SELECT s_suppkey AS constructor_id, '#' || upper(substr(md5(s_name), 1, 6)) AS color_code,
         'assets/constructors-png/circular_logos_32/' || lower(replace(s_name, '#', '-')) || '.png' AS circular_png,
         'assets/constructors-svg/' || lower(replace(s_name, '#', '-')) || '.svg' AS logo_svg
  FROM supplier WHERE s_acctbal > 0),
ref_driver_code AS (
  SELECT c_custkey AS driver_id,
         upper(substr(c_mktsegment, 1, 1)) || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS fia_driver_code
  FROM customer WHERE c_acctbal > 0),
ref_country_image AS (
  SELECT n_name AS country, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code,
         'assets/country-flags-png/flag-' || lower(n_name) || '-32px.png' AS flag_32_png,
         'assets/country-flags-png/flag-' || lower(n_name) || '-64px.png' AS flag_64_png,
         'assets/country-flags-png/flag-' || lower(n_name) || '-128px.png' AS flag_128_png
  FROM nation WHERE n_regionkey < 4)"""

DEFAULT_COLOR = "'#7C8AA5'"
DEFAULT_LOGO = "'assets/constructors-svg/default.svg'"
DEFAULT_FLAG = "'assets/country-flags-png/default-32px.png'"


def views(min_season: int) -> str:
    """CTEs of the eleven views on top of ``GOLD`` (season scope ``>= min_season``)."""
    s = min_season
    hist = ",\n    ".join(f"sum(CASE WHEN final_position = {i} THEN 1 ELSE 0 END) AS p{i}" for i in range(1, 21))
    firsts = ",\n    ".join(f"min(CASE WHEN final_position = {i} THEN round END) AS first_p{i}_round"
                            for i in range(1, 4))

    def standing_order(alias: str, ent: str) -> str:
        keys = ["total_points DESC"] + [f"{alias}.p{i} DESC" for i in range(1, 21)]
        keys += [f"COALESCE({alias}.best_finish, 999)"] + [f"COALESCE({alias}.first_p{i}_round, 999)" for i in (1, 2, 3)]
        keys += [f"{ent} ASC"]
        return ", ".join(keys)

    classified = (f"session_type = 'RACE' AND final_position IS NOT NULL AND final_position > 0 "
                  f"AND (status = 'Finished' OR status LIKE '+%')")
    dnf = "-1 * count_if(status NOT IN ('Finished', 'Lapped') AND status NOT LIKE '+% Lap%')"
    return f"""
v_dim_seasons AS (SELECT DISTINCT season FROM fact WHERE season >= {s}),
v_constructor_reference AS (
  SELECT b.season, b.driver_id, b.constructor_id,
         COALESCE(cc.color_code, {DEFAULT_COLOR}) AS color_code, COALESCE(cc.logo_svg, {DEFAULT_LOGO}) AS cons_logo
  FROM (SELECT season, round, constructor_id, driver_id FROM fact WHERE season >= {s} AND session_type = 'RACE') b
  JOIN (SELECT season, driver_id, max(round) AS max_round FROM fact
        WHERE season >= {s} AND session_type = 'RACE' GROUP BY 1, 2) m
    ON m.season = b.season AND m.driver_id = b.driver_id AND m.max_round = b.round
  LEFT JOIN ref_color cc ON cc.constructor_id = b.constructor_id),
v_constructor_evolution AS (
  SELECT cp.season, cp.round, cp.constructor_id, cp.round_points, c.constructor_name AS cons_name,
         replace(c.constructor_name, ' Team', '') AS constructor_name,
         CAST(rank() OVER (PARTITION BY cp.season, cp.round ORDER BY cp.cumulative_points DESC) AS INTEGER)
           AS constructor_rank,
         cp.cumulative_points, r.circuit_name, replace(r.race_name, 'Grand Prix', 'GP') AS short_race_name,
         COALESCE(cc.color_code, {DEFAULT_COLOR}) AS color_code
  FROM (SELECT *, sum(round_points) OVER (PARTITION BY season, constructor_id ORDER BY round
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_points
        FROM (SELECT season, round, constructor_id, sum(points) AS round_points FROM fact
              WHERE season >= {s} AND session_type IN ('RACE', 'SPRINT') GROUP BY 1, 2, 3)) cp
  LEFT JOIN dim_constructors c ON c.constructor_id = cp.constructor_id
  LEFT JOIN dim_races r ON r.season = cp.season AND r.round = cp.round
  LEFT JOIN ref_color cc ON cc.constructor_id = cp.constructor_id),
drv_round_points AS (
  SELECT season, round, driver_id, sum(points) AS round_points FROM fact
  WHERE season >= {s} AND session_type IN ('RACE', 'SPRINT') GROUP BY 1, 2, 3),
drv_grid AS (
  SELECT r.season, r.round, d.driver_id
  FROM (SELECT DISTINCT season, round FROM drv_round_points) r
  JOIN (SELECT DISTINCT season, driver_id FROM drv_round_points) d ON d.season = r.season),
drv_cumulative AS (
  SELECT g.season, g.round, g.driver_id, COALESCE(p.round_points, 0) AS round_points,
         sum(COALESCE(p.round_points, 0)) OVER (PARTITION BY g.season, g.driver_id ORDER BY g.round
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_points
  FROM drv_grid g LEFT JOIN drv_round_points p
    ON p.season = g.season AND p.round = g.round AND p.driver_id = g.driver_id),
v_driver_evolution AS (
  SELECT cp.season, cp.round, cp.driver_id, dc.fia_driver_code AS driver_code, d.driver_name,
         {short('d.driver_name')} AS short_name, cp.round_points, cp.cumulative_points,
         CAST(rank() OVER (PARTITION BY cp.season, cp.round ORDER BY cp.cumulative_points DESC) AS INTEGER)
           AS driver_rank,
         r.race_name, replace(r.race_name, 'Grand Prix', 'GP') AS short_race_name, r.circuit_name,
         cr.color_code, cr.cons_logo
  FROM drv_cumulative cp
  LEFT JOIN v_constructor_reference cr ON cr.season = cp.season AND cr.driver_id = cp.driver_id
  LEFT JOIN ref_driver_code dc ON dc.driver_id = cp.driver_id
  LEFT JOIN dim_drivers d ON d.driver_id = cp.driver_id
  LEFT JOIN dim_races r ON r.season = cp.season AND r.round = cp.round),
v_constructor_round_wins AS (
  SELECT w.season, w.round, w.constructor_id, CAST(w.round_rank AS INTEGER) AS final_position, c.constructor_name,
         r.circuit_name, replace(r.race_name, 'Grand Prix', 'GP') AS short_race_name,
         COALESCE(cc.color_code, {DEFAULT_COLOR}) AS color_code, cc.logo_svg AS cons_logo,
         COALESCE(ci.flag_32_png, {DEFAULT_FLAG}) AS flag_png
  FROM (SELECT season, round, constructor_id, sum(points) AS round_points,
               rank() OVER (PARTITION BY season, round ORDER BY sum(points) DESC) AS round_rank
        FROM fact WHERE season >= {s} AND session_type = 'RACE' GROUP BY 1, 2, 3
        QUALIFY round_rank = 1) w
  LEFT JOIN dim_constructors c ON c.constructor_id = w.constructor_id
  LEFT JOIN dim_races r ON r.season = w.season AND r.round = w.round
  LEFT JOIN ref_color cc ON cc.constructor_id = w.constructor_id
  LEFT JOIN ref_country_image ci ON ci.country = r.country),
v_driver_round_wins AS (
  SELECT w.season, w.round, w.driver_id, w.constructor_id, w.final_position, d.driver_name,
         dc.fia_driver_code AS driver_code, {short('d.driver_name')} AS short_name, r.circuit_name,
         replace(r.race_name, 'Grand Prix', 'GP') AS short_race_name, cr.color_code, cr.cons_logo,
         COALESCE(ci.flag_32_png, {DEFAULT_FLAG}) AS flag_png
  FROM (SELECT season, round, driver_id, constructor_id, final_position FROM fact
        WHERE season >= {s} AND session_type = 'RACE' AND final_position IN (1, 2, 3, 4, 5)) w
  LEFT JOIN dim_drivers d ON d.driver_id = w.driver_id
  LEFT JOIN dim_races r ON r.season = w.season AND r.round = w.round
  LEFT JOIN ref_driver_code dc ON dc.driver_id = w.driver_id
  LEFT JOIN v_constructor_reference cr ON cr.season = w.season AND cr.driver_id = w.driver_id
  LEFT JOIN ref_country_image ci ON ci.country = r.country),
scoped AS (SELECT * FROM fact WHERE season >= {s} AND session_type IN ('RACE', 'SPRINT')),
drv_points AS (
  SELECT f.season, d.driver_id, d.driver_name, d.nationality, sum(f.points) AS total_points
  FROM scoped f JOIN dim_drivers d ON f.driver_id = d.driver_id GROUP BY 1, 2, 3, 4),
drv_finish AS (
  SELECT season, driver_id, min(final_position) AS best_finish,
    {hist},
    {firsts}
  FROM scoped WHERE {classified} GROUP BY 1, 2),
v_driver_standings AS (
  SELECT p.season, p.driver_id, p.driver_name, {short('p.driver_name')} AS short_name, p.nationality,
         CAST(dense_rank() OVER (PARTITION BY p.season ORDER BY {standing_order('f', 'p.driver_id')}) AS INTEGER)
           AS standing,
         p.total_points, cr.constructor_id, cr.color_code, cr.cons_logo
  FROM drv_points p
  LEFT JOIN drv_finish f ON f.season = p.season AND f.driver_id = p.driver_id
  LEFT JOIN v_constructor_reference cr ON cr.season = p.season AND cr.driver_id = p.driver_id),
con_points AS (
  SELECT f.season, c.constructor_id, c.constructor_name, c.nationality, sum(f.points) AS total_points
  FROM scoped f JOIN dim_constructors c ON f.constructor_id = c.constructor_id GROUP BY 1, 2, 3, 4),
con_finish AS (
  SELECT season, constructor_id, min(final_position) AS best_finish,
    {hist},
    {firsts}
  FROM scoped WHERE {classified} GROUP BY 1, 2),
v_constructor_standings AS (
  SELECT p.season, p.constructor_id, p.constructor_name, p.nationality,
         CAST(dense_rank() OVER (PARTITION BY p.season ORDER BY {standing_order('f', 'p.constructor_id')})
              AS INTEGER) AS standing,
         p.total_points, COALESCE(cc.color_code, {DEFAULT_COLOR}) AS color_code,
         COALESCE(cc.logo_svg, {DEFAULT_LOGO}) AS cons_logo
  FROM con_points p
  LEFT JOIN con_finish f ON f.season = p.season AND f.constructor_id = p.constructor_id
  LEFT JOIN ref_color cc ON cc.constructor_id = p.constructor_id),
v_driver_stats AS (
  SELECT s.season, s.driver_id, d.driver_name, dc.fia_driver_code AS driver_code, s.wins, s.podiums,
         s.finish_in_points, s.pole_positions, s."dnf/dns/dsq", cr.color_code
  FROM (SELECT season, driver_id, count_if(is_win) AS wins, count_if(is_podium) AS podiums,
               count_if(has_points) AS finish_in_points, count_if(is_pole) AS pole_positions,
               {dnf} AS "dnf/dns/dsq"
        FROM fact WHERE season >= {s} AND session_type = 'RACE' GROUP BY 1, 2) s
  LEFT JOIN v_constructor_reference cr ON cr.season = s.season AND cr.driver_id = s.driver_id
  LEFT JOIN ref_driver_code dc ON dc.driver_id = s.driver_id
  LEFT JOIN dim_drivers d ON d.driver_id = s.driver_id),
v_constructor_stats AS (
  SELECT s.season, s.constructor_id, c.constructor_name, COALESCE(cc.color_code, {DEFAULT_COLOR}) AS color_code,
         COALESCE(cc.logo_svg, {DEFAULT_LOGO}) AS cons_logo, s.wins, s.podiums, s.finish_in_points,
         s.pole_positions, s."dnf/dns/dsq"
  FROM (SELECT season, constructor_id, count_if(is_win) AS wins, count_if(is_podium) AS podiums,
               count_if(has_points) AS finish_in_points, count_if(is_pole) AS pole_positions,
               {dnf} AS "dnf/dns/dsq"
        FROM fact WHERE season >= {s} AND session_type = 'RACE' GROUP BY 1, 2) s
  LEFT JOIN ref_color cc ON cc.constructor_id = s.constructor_id
  LEFT JOIN dim_constructors c ON c.constructor_id = s.constructor_id),
v_constructor_drivers_distribution AS (
  SELECT dcp.season, dcp.constructor_id, ct.max_constructor_points, dcp.driver_id, d.driver_name,
         {short('d.driver_name')} AS short_name, dcp.driver_points AS total_driver_points_for_his_constructor,
         COALESCE(cc.color_code, {DEFAULT_COLOR}) AS color_code
  FROM (SELECT season, constructor_id, driver_id, sum(points) AS driver_points FROM scoped GROUP BY 1, 2, 3) dcp
  JOIN (SELECT season, constructor_id, sum(driver_points) AS constructor_points,
               max(sum(driver_points)) OVER (PARTITION BY season) AS max_constructor_points
        FROM (SELECT season, constructor_id, driver_id, sum(points) AS driver_points FROM scoped GROUP BY 1, 2, 3)
        GROUP BY 1, 2 QUALIFY constructor_points = max_constructor_points) ct
    ON dcp.season = ct.season AND dcp.constructor_id = ct.constructor_id
  LEFT JOIN dim_drivers d ON d.driver_id = dcp.driver_id
  LEFT JOIN ref_color cc ON cc.constructor_id = dcp.constructor_id)"""


def with_gold(min_season: int, body: str) -> str:
    """A full statement: gold CTEs + view CTEs + ``body`` (a body's own CTEs are appended)."""
    b = body.lstrip()
    if b[:5].upper() == "WITH ":
        return f"WITH {GOLD},{views(min_season)},\n{b[5:]}"
    return f"WITH {GOLD},{views(min_season)}\n{body}"
