"""Independent SQL for the supplier-panel queries, one statement per query (DuckDB dialect)."""

from __future__ import annotations

CUME = ("Cume_Res_Pos", "Cume_Staff_Pos")
OUT = ("Outbrk_Res_Pos", "Outbrk_Staff_Pos")
REPORT = "State, Facility, ctp_id, Date, Outbrk_Status, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos"

PANEL = """
weekly AS (
  SELECT l_suppkey AS ctp_id, CAST(date_trunc('week', l_shipdate) AS DATE) + 3 AS day,
         CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'CLOSED' END AS Outbrk_Status,
         CAST(sum(l_quantity) AS BIGINT) AS Outbrk_Res_Pos, count(*) AS Outbrk_Staff_Pos
  FROM lineitem GROUP BY ALL),
panel AS (
  SELECT n_name AS State, s_name AS Facility, ctp_id,
         CAST(strftime(day, '%Y%m%d') AS INT) AS Date, Outbrk_Status,
         CAST(sum(Outbrk_Res_Pos) OVER w AS BIGINT) AS Cume_Res_Pos,
         CAST(sum(Outbrk_Staff_Pos) OVER w AS BIGINT) AS Cume_Staff_Pos,
         Outbrk_Res_Pos, Outbrk_Staff_Pos, n_nationkey AS nation_key,
         CAST(date_diff('day', DATE '1995-01-05', day) // 7 AS INT) AS week,
         CAST(strftime(day, '%Y%m%d') AS BIGINT) * 2
           + CASE WHEN Outbrk_Status = 'CLOSED' THEN 1 ELSE 0 END AS _ord
  FROM weekly JOIN supplier ON s_suppkey = ctp_id JOIN nation ON n_nationkey = s_nationkey
  WINDOW w AS (PARTITION BY ctp_id ORDER BY day, Outbrk_Status ROWS UNBOUNDED PRECEDING)),
one AS (
  SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY ctp_id, Date ORDER BY _ord) = 1)"""


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([PANEL.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


def thin(src: str, out: str) -> str:
    return f"{out} AS (SELECT * FROM {src} WHERE (nation_key + week) % 5 <> 0)"


def fill(src: str, out: str) -> str:
    """Weeks without any row of the state repeat its latest earlier report."""
    return f"""
{out}_grid AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS g
  FROM generate_series(DATE '1995-01-05', DATE '2001-11-01', INTERVAL 7 DAY) AS t(d)),
{out}_source AS (
  SELECT State, g, max(Date) AS from_date
  FROM (SELECT DISTINCT State, Date FROM {src}) JOIN {out}_grid ON Date <= g GROUP BY State, g),
{out} AS (
  SELECT * FROM {src} UNION ALL
  SELECT r.* REPLACE (s.g AS Date, NULL AS Outbrk_Status, NULL AS Outbrk_Res_Pos, NULL AS Outbrk_Staff_Pos)
  FROM {out}_source s JOIN {src} r ON r.State = s.State AND r.Date = s.from_date
  WHERE s.from_date < s.g)"""


def close(src: str, out: str) -> str:
    """Entities absent on a state date repeat the first row of their last report."""
    return f"""
{out}_last AS (
  SELECT e.State, e.ctp_id, d.Date AS at, max(e.Date) AS reported
  FROM (SELECT DISTINCT State, ctp_id, Date FROM {src}) e
  JOIN (SELECT DISTINCT State, Date FROM {src}) d ON d.State = e.State AND e.Date <= d.Date
  GROUP BY ALL),
{out}_first AS (
  SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY State, ctp_id, Date ORDER BY _ord) = 1),
{out} AS (
  SELECT *, Date AS last_recorded FROM {src} UNION ALL
  SELECT f.* REPLACE (l.at AS Date, 'Closed' AS Outbrk_Status, NULL AS Outbrk_Res_Pos, NULL AS Outbrk_Staff_Pos),
         l.reported AS last_recorded
  FROM {out}_last l JOIN {out}_first f ON f.State = l.State AND f.ctp_id = l.ctp_id AND f.Date = l.reported
  WHERE l.reported < l.at)"""


def collapse(src: str, out: str) -> str:
    """Sum clean slots into their OPEN or first row (numeric totals, no rivals)."""
    return f"""
{out} AS (
  SELECT * EXCLUDE (nth) REPLACE (
    CASE WHEN res + coalesce(Outbrk_Res_Pos, 0) > 0 THEN res + coalesce(Outbrk_Res_Pos, 0)
         ELSE Cume_Res_Pos END AS Cume_Res_Pos,
    CASE WHEN staff + coalesce(Outbrk_Staff_Pos, 0) > 0 THEN staff + coalesce(Outbrk_Staff_Pos, 0)
         ELSE Cume_Staff_Pos END AS Cume_Staff_Pos)
  FROM (SELECT *, CAST(sum(coalesce(Cume_Res_Pos, 0)) OVER g AS BIGINT) AS res,
               CAST(sum(coalesce(Cume_Staff_Pos, 0)) OVER g AS BIGINT) AS staff,
               row_number() OVER (PARTITION BY State, ctp_id, Date
                                  ORDER BY CASE WHEN Outbrk_Status = 'OPEN' THEN 0 ELSE 1 END, _ord) AS nth
        FROM {src} WINDOW g AS (PARTITION BY State, ctp_id, Date))
  WHERE nth = 1)"""


def carry(src: str, out: str, since: int) -> str:
    return f"""
{out}_seq AS (
  SELECT *, row_number() OVER w AS r, lag(Outbrk_Status) OVER w AS before,
         lag(Outbrk_Res_Pos) OVER w AS before_res, lag(Outbrk_Staff_Pos) OVER w AS before_staff
  FROM {src} WINDOW w AS (PARTITION BY ctp_id ORDER BY Date, _ord)),
{out}_hit AS (
  SELECT ctp_id, r AS from_r, before_res, before_staff FROM {out}_seq
  WHERE Date >= {since} AND Outbrk_Status = 'CLOSED' AND before = 'OPEN'
  QUALIFY row_number() OVER (PARTITION BY ctp_id ORDER BY r DESC) = 1),
{out} AS (
  SELECT s.* REPLACE (
    CASE WHEN r < from_r OR from_r IS NULL OR h.before_res IS NULL THEN Cume_Res_Pos
         ELSE coalesce(Cume_Res_Pos, 0) + h.before_res END AS Cume_Res_Pos,
    CASE WHEN r < from_r OR from_r IS NULL OR h.before_staff IS NULL THEN Cume_Staff_Pos
         ELSE coalesce(Cume_Staff_Pos, 0) + h.before_staff END AS Cume_Staff_Pos)
  FROM {out}_seq s LEFT JOIN {out}_hit h USING (ctp_id))"""


def past(src: str, out: str) -> str:
    return f"""
{out}_seq AS (
  SELECT *, row_number() OVER w > 2 AND upper(Outbrk_Status) = 'OPEN'
            AND upper(lag(Outbrk_Status) OVER w) = 'CLOSED' AS again,
         lag(Cume_Res_Pos) OVER w AS last_res, lag(Cume_Staff_Pos) OVER w AS last_staff
  FROM {src} WINDOW w AS (PARTITION BY ctp_id ORDER BY Date, _ord)),
{out}_sum AS (
  SELECT *, count(*) FILTER (again) OVER w AS events,
         CAST(coalesce(sum(last_res) FILTER (again) OVER w, 0) AS BIGINT) AS add_res,
         CAST(coalesce(sum(last_staff) FILTER (again) OVER w, 0) AS BIGINT) AS add_staff
  FROM {out}_seq WINDOW w AS (PARTITION BY ctp_id ORDER BY Date, _ord ROWS UNBOUNDED PRECEDING)),
{out} AS (
  SELECT * REPLACE (
    CASE WHEN events = 0 THEN Cume_Res_Pos
         WHEN add_res + coalesce(Cume_Res_Pos, 0) > 0 THEN add_res + coalesce(Cume_Res_Pos, 0) END AS Cume_Res_Pos,
    CASE WHEN events = 0 THEN Cume_Staff_Pos
         WHEN add_staff + coalesce(Cume_Staff_Pos, 0) > 0 THEN add_staff + coalesce(Cume_Staff_Pos, 0) END AS Cume_Staff_Pos)
  FROM {out}_sum)"""


def unknown_closed(src: str, out: str) -> str:
    return f"{out} AS (SELECT * REPLACE (coalesce(Outbrk_Status, 'Closed') AS Outbrk_Status) FROM {src})"


LABELLED = r"""
labelled AS (
  SELECT CAST(Date AS VARCHAR) AS Date, ' ' || lower(State) || chr(9) || ' ' AS State,
         CASE WHEN ctp_id % 4 <> 0 THEN 'North  ' || State || ' county' END AS County,
         'Saint‐Paul ' || chr(10) || ' West' AS City,
         replace(Facility, '#0', '  §#Ͳ ') AS Facility, lower(Outbrk_Status) AS Outbrk_Status,
         '  nursing' || chr(9) || 'home' AS State_Facility_Type, 'Nursing Home' AS CTP_Facility_Type,
         ctp_id, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos
  FROM panel)"""


def _tidy(c: str) -> str:
    return rf"trim(regexp_replace(upper(coalesce({c}, '')), '\s+', ' ', 'g'))"


def _name(c: str) -> str:
    return f"replace(replace(replace({_tidy(c)}, '§', ''), 'Ͳ', '-'), '‐', '-')"


TIDY = f"""
  SELECT CAST(Date AS INT) AS Date, {_tidy('State')} AS State, {_name('County')} AS County,
         {_name('City')} AS City, {_name('Facility')} AS Facility, {_tidy('Outbrk_Status')} AS Outbrk_Status,
         {_tidy('State_Facility_Type')} AS State_Facility_Type, {_tidy('CTP_Facility_Type')} AS CTP_Facility_Type,
         ctp_id, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos"""

REGISTRY = """
entries AS (
  SELECT upper(s_name) AS Facility, 'REGION ' || n_regionkey AS County, n_name AS State,
         s_suppkey AS key FROM supplier JOIN nation ON n_nationkey = s_nationkey),
asked AS (
  SELECT p.State, upper(p.Facility) AS Facility, 'REGION ' || n_regionkey AS County, Date, Outbrk_Status,
         ctp_id AS s_suppkey FROM panel p JOIN nation ON n_name = p.State)"""

DIRTY = """
noisy AS (
  SELECT * REPLACE (CAST(Cume_Res_Pos AS VARCHAR) AS Cume_Res_Pos, _ord * 4 AS _ord,
    CASE WHEN (ctp_id + week) % 19 = 0 THEN '<11' WHEN (ctp_id + week) % 23 = 0 THEN NULL
         ELSE CAST(Cume_Staff_Pos AS VARCHAR) END AS Cume_Staff_Pos) FROM panel),
dirty AS (
  SELECT *, CASE WHEN ctp_id % 3 = 0 THEN 'RCFE' WHEN ctp_id % 2 = 0 THEN 'Residential Care' ELSE 'NH' END
            AS State_Facility_Type
  FROM (SELECT * FROM noisy
        UNION ALL SELECT * REPLACE (_ord + 1 AS _ord) FROM noisy WHERE (ctp_id + week) % 17 = 0
        UNION ALL SELECT * REPLACE (_ord + 2 AS _ord, Outbrk_Res_Pos + 1 AS Outbrk_Res_Pos) FROM noisy
                  WHERE (ctp_id + week) % 13 = 0 AND Outbrk_Status = 'OPEN')),
slots AS (
  SELECT State, ctp_id, Date, count(*) AS n, count(*) FILTER (Outbrk_Status = 'OPEN') AS n_open,
         count(DISTINCT Outbrk_Res_Pos) FILTER (Outbrk_Status = 'OPEN') AS open_kinds,
         count(DISTINCT Outbrk_Status || Outbrk_Res_Pos) AS kinds,
         coalesce(min(_ord) FILTER (Outbrk_Status = 'OPEN'), min(_ord)) AS kept, min(_ord) AS first_ord,
         bool_or(coalesce(Cume_Staff_Pos = '<11', FALSE)) AS junk,
         CAST(sum(TRY_CAST(Cume_Res_Pos AS BIGINT)) AS BIGINT) AS res,
         CAST(sum(coalesce(TRY_CAST(Cume_Staff_Pos AS BIGINT), 0)) AS BIGINT) AS staff,
         max(Cume_Res_Pos) FILTER (Outbrk_Status <> 'OPEN') AS other_res,
         max(Cume_Staff_Pos) FILTER (Outbrk_Status <> 'OPEN') AS other_staff,
         min(State_Facility_Type) AS kind, min(Facility) AS Facility
  FROM dirty GROUP BY State, ctp_id, Date)"""


def no_add(listed: bool) -> str:
    asis = "n <> 2" + (" OR kind = 'NH'" if listed else "") + " OR (kinds > 1 AND n_open <> 1)"
    extra = ", State_Facility_Type" if listed else ""
    return f"""
SELECT {REPORT}{extra} FROM (
  SELECT d.* EXCLUDE (Cume_Res_Pos, Cume_Staff_Pos), ({asis}) AS as_is, kinds, first_ord, kept,
    CASE WHEN ({asis}) OR kinds = 1 THEN Cume_Res_Pos ELSE other_res END AS Cume_Res_Pos,
    CASE WHEN ({asis}) OR kinds = 1 THEN Cume_Staff_Pos ELSE other_staff END AS Cume_Staff_Pos
  FROM dirty d JOIN (SELECT * EXCLUDE (Facility) FROM slots) s
    ON d.State = s.State AND d.ctp_id = s.ctp_id AND d.Date = s.Date)
WHERE as_is OR (kinds = 1 AND _ord = first_ord) OR (kinds > 1 AND _ord = kept)"""


def over(ctes: str, src: str) -> str:
    """The same noise on another source than the panel."""
    return ctes.replace("FROM panel)", f"FROM {src})")


NEW_YEAR = """
ny AS (
  SELECT * EXCLUDE (Cume_Staff_Pos), (ctp_id + week) % 4 = 0 AS junk,
         CASE WHEN (ctp_id + week) % 4 = 0 THEN '<11' ELSE CAST(Cume_Staff_Pos AS VARCHAR) END AS Cume_Staff_Pos
  FROM one),
listed AS (SELECT DISTINCT State, Date AS d FROM ny WHERE Date > 20010921),
began AS (SELECT State, ctp_id, min(Date) FILTER (Date > 20010921) AS first_new,
                 count(*) FILTER (Date > 20010921) AS n_new FROM ny GROUP BY ALL),
ents AS (
  SELECT b.State, b.ctp_id, n_new = 0 OR n_new = (
           SELECT count(*) FROM listed l WHERE l.State = b.State AND l.d >= b.first_new) AS gapless,
         base.Cume_Res_Pos AS base_res, TRY_CAST(base.Cume_Staff_Pos AS BIGINT) AS base_staff,
         base.junk AS base_junk, base.ctp_id IS NOT NULL AS has_base
  FROM began b LEFT JOIN ny base ON base.ctp_id = b.ctp_id AND base.Date = 20010920)"""

UNDONE = """
SELECT n.State, n.Facility, n.ctp_id, n.Date, n.Outbrk_Status,
       CASE WHEN e.gapless AND e.has_base AND n.Date >= 20010921 THEN e.base_res + n.Cume_Res_Pos
            ELSE n.Cume_Res_Pos END AS Cume_Res_Pos,
       CASE WHEN e.gapless AND e.has_base AND n.Date >= 20010921 AND NOT n.junk AND NOT e.base_junk
            THEN CAST(e.base_staff + CAST(n.Cume_Staff_Pos AS BIGINT) AS VARCHAR)
            ELSE n.Cume_Staff_Pos END AS Cume_Staff_Pos, n.Outbrk_Res_Pos, n.Outbrk_Staff_Pos
FROM ny n JOIN ents e USING (State, ctp_id)
UNION ALL
SELECT f.State, f.Facility, f.ctp_id, l.d, f.Outbrk_Status, e.base_res, CAST(e.base_staff AS VARCHAR), NULL, NULL
FROM ents e JOIN (SELECT * FROM ny QUALIFY row_number() OVER (PARTITION BY ctp_id ORDER BY _ord) = 1) f
  ON f.ctp_id = e.ctp_id
JOIN listed l ON l.State = e.State
WHERE e.gapless AND e.has_base
  AND NOT EXISTS (SELECT 1 FROM ny x WHERE x.ctp_id = e.ctp_id AND x.Date = l.d)"""

TYPED = """
typed AS (
  SELECT *, CASE WHEN (ctp_id + week) % 6 = 0 THEN '' WHEN ctp_id % 4 = 0 THEN 'ALF'
                 WHEN (ctp_id + week) % 9 = 0 AND ctp_id % 5 = 0 THEN 'ICF' ELSE 'NH' END AS State_Facility_Type,
         CASE WHEN (ctp_id + week) % 3 = 0 THEN NULL
              ELSE 'C' || ctp_id || CASE WHEN week % 8 = 0 THEN 'X' ELSE '' END END AS CMS_ID,
         CASE WHEN (ctp_id + week) % 7 = 0 THEN '' WHEN ctp_id % 10 = 0 AND week % 2 = 0 THEN 'EAST'
              ELSE 'C' || State END AS County
  FROM panel)"""
PEERS = "State, Facility, ctp_id, Date, Outbrk_Status, State_Facility_Type, CMS_ID, County"


RULES = """
rules AS (
  SELECT * REPLACE (CASE WHEN Outbrk_Res_Pos IS NOT NULL OR Outbrk_Staff_Pos IS NOT NULL THEN 'OPEN' END AS Outbrk_Status)
  FROM (SELECT * REPLACE (
      CASE WHEN week % 13 = 0 THEN '' WHEN week % 11 = 0 OR week % 7 = 0 THEN 'MIAMI-DADE' ELSE County END AS County,
      CASE WHEN (ctp_id + week) % 4 <> 0 THEN Outbrk_Res_Pos END AS Outbrk_Res_Pos,
      CASE WHEN (ctp_id + week) % 2 <> 0 THEN Outbrk_Staff_Pos END AS Outbrk_Staff_Pos,
      CASE WHEN (ctp_id + week) % 8 <> 0 THEN Cume_Staff_Pos END AS Cume_Staff_Pos)
    FROM typed WHERE week % 15 <> 0))"""


def fl_types(src: str, out: str) -> str:
    """Common types and regulators; only nursing homes keep their federal id."""
    return f"""
{out} AS (
  SELECT * REPLACE (CASE WHEN State_Facility_Type = 'NH' THEN CMS_ID END AS CMS_ID),
         CASE State_Facility_Type WHEN 'ALF' THEN 'Assisted Living' WHEN 'NH' THEN 'Nursing Home'
              WHEN 'ICF' THEN 'Other' END AS CTP_Facility_Type,
         CASE State_Facility_Type WHEN 'NH' THEN 'Federal' WHEN 'ALF' THEN 'State' WHEN 'ICF' THEN 'State' END AS Regulate
  FROM {src})"""


def peer_types(src: str, out: str) -> str:
    return f"""
{out}_kinds AS (
  SELECT State, Facility, kind FROM (
    SELECT State, Facility, State_Facility_Type AS kind, count(*) AS n,
           bool_or(State_Facility_Type = 'NH') OVER f AND bool_or(State_Facility_Type IN ('ALF', 'ICF')) OVER f AS mixed
    FROM {src} WHERE State_Facility_Type <> '' GROUP BY State, Facility, State_Facility_Type
    WINDOW f AS (PARTITION BY State, Facility))
  WHERE NOT mixed QUALIFY row_number() OVER (PARTITION BY State, Facility ORDER BY n DESC, kind) = 1),
{out}_ids AS (
  SELECT State, Facility, CMS_ID AS fed FROM (
    SELECT State, Facility, CMS_ID, count(*) AS n FROM {src}
    WHERE State_Facility_Type <> '' AND CMS_ID IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY State, Facility ORDER BY n DESC, CMS_ID) = 1),
{out} AS (
  SELECT t.* REPLACE (
    CASE WHEN t.State_Facility_Type = '' AND k.kind IS NOT NULL THEN k.kind
         ELSE t.State_Facility_Type END AS State_Facility_Type,
    CASE WHEN t.State_Facility_Type = '' AND k.kind = 'NH' THEN coalesce(i.fed, t.CMS_ID)
         ELSE t.CMS_ID END AS CMS_ID)
  FROM {src} t LEFT JOIN {out}_kinds k ON k.State = t.State AND k.Facility = t.Facility
  LEFT JOIN {out}_ids i ON i.State = t.State AND i.Facility = t.Facility)"""


def peer_counties(src: str, out: str) -> str:
    return f"""
{out} AS (
  SELECT t.* REPLACE (
    CASE WHEN t.County <> '' THEN t.County
         WHEN t.State_Facility_Type = '' AND a.n = 1 THEN a.c
         WHEN t.State_Facility_Type <> '' AND s.n = 1 THEN s.c ELSE '' END AS County)
  FROM {src} t
  LEFT JOIN (SELECT State, Facility, count(DISTINCT County) AS n, min(County) AS c FROM {src}
             WHERE County <> '' GROUP BY ALL) a ON a.State = t.State AND a.Facility = t.Facility
  LEFT JOIN (SELECT State, Facility, State_Facility_Type AS k, count(DISTINCT County) AS n, min(County) AS c
             FROM {src} WHERE County <> '' GROUP BY ALL) s
    ON s.State = t.State AND s.Facility = t.Facility AND s.k = t.State_Facility_Type)"""


def suspect(src: str) -> str:
    return f"""
suspect AS (
  SELECT * REPLACE (
    CASE WHEN (ctp_id + week) % 13 = 0 THEN '<11' WHEN (ctp_id + week) % 29 = 0 THEN 'Data Pending'
         WHEN (ctp_id + week) % 17 = 0 THEN CAST(Cume_Res_Pos - 400 AS VARCHAR)
         ELSE CAST(Cume_Res_Pos AS VARCHAR) END AS Cume_Res_Pos,
    CASE WHEN (ctp_id + week) % 31 = 0 THEN '58 *' WHEN (ctp_id + week) % 7 = 0 THEN NULL
         WHEN (ctp_id + week) % 5 = 0 THEN CAST(Cume_Staff_Pos AS VARCHAR) || '.5'
         ELSE CAST(Cume_Staff_Pos AS VARCHAR) END AS Cume_Staff_Pos) FROM {src})"""


def _decrease(src: str, only: str = "") -> str:
    return sql(f"""
SELECT State, Facility, field AS cumulative_field_decreased, Date, now AS current_cumulative_value,
       prev_date AS "Prev Date", was AS prev_cumulative_value, 'Nursing Home' AS CTP_Facility_Type, ctp_id
FROM (SELECT *, 'Cume_Res_Pos' AS field, res AS now, prev_res AS was FROM seq
      UNION ALL SELECT *, 'Cume_Staff_Pos', staff, prev_staff FROM seq)
WHERE now <> -1 AND now < was {only}""", suspect(src), """
cells AS (
  SELECT State, Facility, Date, ctp_id, _ord,
         CASE Cume_Res_Pos WHEN '<11' THEN 1 ELSE CAST(Cume_Res_Pos AS BIGINT) END AS res,
         CASE WHEN Cume_Staff_Pos IS NULL THEN -1 WHEN Cume_Staff_Pos = '58 *' THEN 58
              ELSE CAST(split_part(Cume_Staff_Pos, '.', 1) AS BIGINT) END AS staff
  FROM suspect WHERE Cume_Res_Pos <> 'Data Pending'),
seq AS (
  SELECT *, lag(Date) OVER w AS prev_date, lag(res) OVER w AS prev_res, lag(staff) OVER w AS prev_staff,
         max(Date) OVER (PARTITION BY State) AS latest
  FROM cells WINDOW w AS (PARTITION BY ctp_id ORDER BY Date, _ord))""")


RECON = """
fed AS (
  SELECT strftime(strptime(CAST(Date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS cms_week,
         CAST(ctp_id + 1 AS VARCHAR) AS cms_federal_provider_number, Facility AS cms_provider_name,
         State AS cms_provider_state, Cume_Res_Pos AS cms_cases,
         CASE WHEN (ctp_id + week) % 3 <> 0 THEN Outbrk_Res_Pos END AS cms_suspected,
         CASE WHEN (ctp_id + week) % 10 <> 0 THEN Cume_Staff_Pos END AS cms_deaths,
         coalesce(cms_cases, 0) + coalesce(cms_suspected, 0) AS cms_total_cases
  FROM panel WHERE Outbrk_Status = 'OPEN' AND Date > 19950201),
nat AS (
  SELECT strftime(strptime(CAST(Date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS ctp_cms_week,
         CASE WHEN (ctp_id + week) % 12 <> 0 THEN CAST(ctp_id + 1 AS VARCHAR) END AS ctp_cms_id,
         Facility AS ctp_facility, State AS ctp_state, ctp_id AS ctp_ctp_id,
         CASE WHEN ctp_id % 4 = 0 THEN 'Nursing Home' ELSE 'Uncategorized' END AS ctp_ctp_facility_type,
         Cume_Res_Pos AS ctp_cases,
         CASE WHEN (ctp_id + week) % 5 = 0 THEN Outbrk_Res_Pos END AS ctp_probable,
         CASE WHEN (ctp_id + week) % 11 <> 0 THEN Cume_Staff_Pos END AS ctp_deaths,
         coalesce(ctp_cases, 0) + coalesce(ctp_probable, 0) AS ctp_total_cases,
         coalesce(ctp_deaths, 0) AS ctp_total_deaths
  FROM panel WHERE Outbrk_Status = 'CLOSED'),
both_sides AS (
  SELECT *, cms_total_cases - ctp_total_cases AS cms_ctp_cases_diff,
         abs(cms_total_cases - ctp_total_cases) AS cms_ctp_cases_diff_abs,
         cms_deaths - ctp_total_deaths AS cms_ctp_deaths_diff,
         abs(cms_deaths - ctp_total_deaths) AS cms_ctp_deaths_diff_abs
  FROM fed JOIN nat ON cms_week = ctp_cms_week AND cms_federal_provider_number = ctp_cms_id),
either AS (
  SELECT * FROM fed FULL JOIN nat ON cms_week = ctp_cms_week AND cms_federal_provider_number = ctp_cms_id),
last_week AS (SELECT max(ctp_cms_week) AS latest FROM both_sides)"""


def recon(body: str, *ctes: str) -> str:
    return sql(body, RECON, *ctes)


def part(src: str, out: str, state: str) -> str:
    return f"{out} AS (SELECT * FROM {src} WHERE State = '{state}')"


READY = """
ready AS (SELECT * REPLACE (upper(Facility) AS Facility) FROM panel WHERE (nation_key + week) % 5 <> 0)"""

LOCF = """
SELECT n.State, n.Facility, n.ctp_id, n.Date, n.Outbrk_Status,
       CASE WHEN n.Cume_Res_Pos = 'no data' THEN nullif(p.res, 'none') ELSE n.Cume_Res_Pos END AS Cume_Res_Pos,
       CASE WHEN n.Cume_Staff_Pos = 'not reported' THEN nullif(p.staff, 'none')
            ELSE n.Cume_Staff_Pos END AS Cume_Staff_Pos, n.Outbrk_Res_Pos, n.Outbrk_Staff_Pos
FROM noisy n JOIN prior p ON p.ctp_id = n.ctp_id AND p.Date = n.Date"""

MARKED = """
noisy AS (
  SELECT * REPLACE (
    CASE WHEN (ctp_id + week) % 11 = 0 THEN 'no data' ELSE CAST(Cume_Res_Pos AS VARCHAR) END AS Cume_Res_Pos,
    CASE WHEN (ctp_id + week) % 7 = 0 THEN 'not reported' WHEN (ctp_id + week) % 9 = 0 THEN NULL
         ELSE CAST(Cume_Staff_Pos AS VARCHAR) END AS Cume_Staff_Pos) FROM panel),
firsts AS (SELECT * FROM noisy QUALIFY row_number() OVER (PARTITION BY ctp_id, Date ORDER BY _ord) = 1),
prior AS (
  SELECT ctp_id, Date,
         last_value(CASE WHEN Cume_Res_Pos <> 'no data' THEN Cume_Res_Pos END IGNORE NULLS) OVER w AS res,
         last_value(CASE WHEN Cume_Staff_Pos IS NULL THEN 'none'
                         WHEN Cume_Staff_Pos <> 'not reported' THEN Cume_Staff_Pos END IGNORE NULLS) OVER w AS staff
  FROM firsts WINDOW w AS (PARTITION BY ctp_id ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

GAPS = """
SELECT * FROM (
  SELECT State, Facility, ctp_id, Date, Outbrk_Status,
         CASE WHEN (ctp_id + week) % 3 <> 0 THEN Cume_Res_Pos END AS Cume_Res_Pos,
         CASE WHEN (ctp_id + week) % 6 <> 0 THEN Cume_Staff_Pos END AS Cume_Staff_Pos,
         CASE WHEN (ctp_id + week) % 6 <> 0 THEN Outbrk_Res_Pos END AS Outbrk_Res_Pos,
         CASE WHEN (ctp_id + week) % 9 <> 0 THEN Outbrk_Staff_Pos END AS Outbrk_Staff_Pos FROM panel)
WHERE coalesce(Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos) IS NOT NULL"""

DISTINCT = """
d AS (
  SELECT State, ctp_id, Date, Outbrk_Status, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos,
         min(_ord) AS _ord,
         CAST(Cume_Res_Pos AS BIGINT) AS res,
         CASE WHEN Cume_Staff_Pos IS NULL THEN -1 WHEN Cume_Staff_Pos = '<11' THEN 1
              ELSE CAST(Cume_Staff_Pos AS BIGINT) END AS staff
  FROM dirty GROUP BY State, ctp_id, Date, Outbrk_Status, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos),
seq AS (SELECT *, lag(res) OVER w AS was_res, lag(staff) OVER w AS was_staff
        FROM d WINDOW w AS (PARTITION BY ctp_id ORDER BY Date, _ord))"""


STATES = sql(f"""
SELECT {REPORT}, CAST(NULL AS INT) AS last_recorded FROM ct_done
UNION ALL SELECT {REPORT}, last_recorded FROM ar_done
UNION ALL SELECT {REPORT}, NULL FROM co_done
UNION ALL SELECT {REPORT}, last_recorded FROM nj_done
UNION ALL SELECT {REPORT}, last_recorded FROM wy_done""", READY, """
coded AS (SELECT * REPLACE (['CT', 'AR', 'CO', 'NJ', 'WY'][nation_key % 5 + 1] AS State) FROM ready)""",
    part("coded", "ct", "CT"), fill("ct", "ct_done"),
    part("coded", "ar", "AR"), close("ar", "ar_closed"), fill("ar_closed", "ar_done"),
    part("coded", "co", "CO"), collapse("co", "co_merged"), fill("co_merged", "co_done"),
    part("coded", "nj", "NJ"), close("nj", "nj_closed"),
    "nj_recent AS (SELECT * FROM nj_closed WHERE Date >= 19960101)", collapse("nj_recent", "nj_merged"),
    carry("nj_merged", "nj_carried", 19970101), fill("nj_carried", "nj_done"),
    part("coded", "wy", "WY"), collapse("wy", "wy_merged"), close("wy_merged", "wy_closed"),
    fill("wy_closed", "wy_filled"), unknown_closed("wy_filled", "wy_known"), past("wy_known", "wy_summed"),
    fill("wy_summed", "wy_again"), unknown_closed("wy_again", "wy_done"))

_STEPS = {  # of each state: its chain and the table after each step
    "CT": ("plain", {"standardize": "ct", "finish": "ct_done"}),
    "AR": ("closing", {"standardize": "ar", "close_missing": "ar_closed", "finish": "ar_done"}),
    "CO": ("collapsing", {"standardize": "co", "collapse_adding": "co_merged", "finish": "co_done"}),
    "NJ": ("new_jersey", {"standardize": "nj", "close_missing": "nj_closed", "since": "nj_recent",
                          "collapse_adding": "nj_merged", "carry_closed_event": "nj_carried", "finish": "nj_done"}),
    "WY": ("wyoming", {"standardize": "wy", "collapse_adding": "wy_merged", "close_missing": "wy_closed",
                       "sum_outbreaks": "wy_summed", "finish": "wy_done"})}
STEPS = STATES[:STATES.rindex("SELECT State, Facility, ctp_id, Date, Outbrk_Status, Cume_Res_Pos, Cume_Staff_Pos, "
                              "Outbrk_Res_Pos, Outbrk_Staff_Pos, CAST(NULL AS INT)")] + "\nUNION ALL ".join(
    f"SELECT '{state}' AS State, '{chain}' AS chain, {nth}::INT AS nth, '{step}' AS step, count(*) AS \"rows\" FROM {src}"
    for state, (chain, tables) in _STEPS.items()
    for nth, (step, src) in enumerate([("read", next(iter(tables.values()))), *tables.items()]))

PAST_TEXT = """
past AS (
  SELECT *, count(*) FILTER (again) OVER w AS events, count(*) FILTER (again AND last_junk) OVER w AS texts,
         CAST(coalesce(sum(last_res) FILTER (again) OVER w, 0) AS BIGINT) AS add_res,
         CAST(coalesce(sum(TRY_CAST(last_staff AS BIGINT)) FILTER (again) OVER w, 0) AS BIGINT) AS add_staff
  FROM (SELECT *, row_number() OVER v > 2 AND Outbrk_Status = 'OPEN' AND lag(Outbrk_Status) OVER v = 'CLOSED' AS again,
               lag(Cume_Res_Pos) OVER v AS last_res, lag(Cume_Staff_Pos) OVER v AS last_staff, lag(junk) OVER v AS last_junk
        FROM ny WINDOW v AS (PARTITION BY ctp_id ORDER BY Date, _ord))
  WINDOW w AS (PARTITION BY ctp_id ORDER BY Date, _ord ROWS UNBOUNDED PRECEDING))"""


SQL: dict[str, str] = {
    "std_text": sql(TIDY + " FROM labelled", LABELLED),
    "std_dedup": sql("SELECT DISTINCT * FROM (" + TIDY + """ FROM (
        SELECT * FROM labelled UNION ALL
        SELECT * REPLACE (upper(Facility) AS Facility) FROM labelled WHERE ctp_id % 3 = 0))""", LABELLED),
    "entity_lookup": sql("""
SELECT a.*, 'S' || e.key AS ctp_id FROM asked a JOIN entries e USING (Facility, County, State)""", REGISTRY),
    "entity_unmatched": sql("""
SELECT Facility, '' AS City, County, State, 'SUPPLIER' AS CTP_Facility_Type, count(*) AS "rows"
FROM asked a WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e.key % 7 <> 0 AND e.Facility = a.Facility
                               AND e.County = a.County AND e.State = a.State)
GROUP BY ALL""", REGISTRY),
    "fill_missing_dates": sql(f"SELECT {REPORT} FROM filled", thin("panel", "t"), fill("t", "filled")),
    "close_missing": sql(f"SELECT {REPORT}, last_recorded FROM closed", close("panel", "closed")),
    "locf_markers": sql(LOCF, MARKED),
    "collapse_add": sql(f"""
SELECT {REPORT} FROM (
  SELECT d.* EXCLUDE (Cume_Res_Pos, Cume_Staff_Pos), junk OR open_kinds > 1 AS as_is, kept,
         CASE WHEN junk OR open_kinds > 1 OR res + Outbrk_Res_Pos <= 0 THEN Cume_Res_Pos
              ELSE CAST(res + Outbrk_Res_Pos AS VARCHAR) END AS Cume_Res_Pos,
         CASE WHEN junk OR open_kinds > 1 OR staff + Outbrk_Staff_Pos <= 0 THEN Cume_Staff_Pos
              ELSE CAST(staff + Outbrk_Staff_Pos AS VARCHAR) END AS Cume_Staff_Pos
  FROM dirty d JOIN (SELECT * EXCLUDE (Facility) FROM slots) s
    ON d.State = s.State AND d.ctp_id = s.ctp_id AND d.Date = s.Date)
WHERE as_is OR _ord = kept""", DIRTY),
    "collapse_diagnostics": sql("""
SELECT State, ctp_id, Date, n_open AS open_rows, open_kinds > 1 OR n_open > 1 AS rows_differ, "column", value, count(*) AS "rows"
FROM (SELECT d.State, d.ctp_id, d.Date, n_open, open_kinds, 'Facility' AS "column",
             d.Facility || ' ' || (d._ord % 4) AS value
      FROM dirty d JOIN slots s ON d.State = s.State AND d.ctp_id = s.ctp_id AND d.Date = s.Date
      WHERE Outbrk_Status = 'OPEN' AND n_open > 1
      UNION ALL
      SELECT d.State, d.ctp_id, d.Date, n_open, open_kinds, 'State_Facility_Type', State_Facility_Type
      FROM dirty d JOIN slots s ON d.State = s.State AND d.ctp_id = s.ctp_id AND d.Date = s.Date
      WHERE Outbrk_Status = 'OPEN' AND n_open > 1)
GROUP BY ALL""", DIRTY),
    "collapse_no_add": sql(no_add(False), DIRTY),
    "collapse_no_add_listed": sql(no_add(True), DIRTY),
    "carry_closed": sql(f"SELECT {REPORT} FROM carried", carry("one", "carried", 19970101)),
    "carry_closed_many_rows": sql(f"SELECT {REPORT} FROM carried", carry("panel", "carried", 19970101)),
    "sum_outbreaks": sql(f"SELECT {REPORT} FROM summed", thin("one", "t"), fill("t", "filled"),
                         unknown_closed("filled", "known"), past("known", "summed")),
    "sum_outbreaks_many_rows": sql(f"SELECT {REPORT} FROM summed", past("panel", "summed")),
    "sum_outbreaks_text": sql(f"""
SELECT State, Facility, ctp_id, Date, Outbrk_Status,
       CASE WHEN events = 0 THEN Cume_Res_Pos WHEN add_res + Cume_Res_Pos > 0 THEN add_res + Cume_Res_Pos END AS Cume_Res_Pos,
       CASE WHEN events = 0 OR junk OR texts > 0 THEN Cume_Staff_Pos
            WHEN add_staff + CAST(Cume_Staff_Pos AS BIGINT) > 0
            THEN CAST(add_staff + CAST(Cume_Staff_Pos AS BIGINT) AS VARCHAR) END AS Cume_Staff_Pos,
       Outbrk_Res_Pos, Outbrk_Staff_Pos FROM past""", NEW_YEAR, PAST_TEXT),
    "unreadable_closings": sql("""
SELECT DISTINCT State, ctp_id, 'Cume_Staff_Pos' AS "column" FROM past WHERE texts > 0""", NEW_YEAR, PAST_TEXT),
    "undo_reset": sql(UNDONE, NEW_YEAR),
    "early_leavers": sql("""
SELECT DISTINCT n.State, n.Facility FROM ny n JOIN ents e USING (State, ctp_id)
WHERE e.gapless AND NOT e.has_base""", NEW_YEAR),
    "drop_all_null": sql(GAPS),
    "fl_rules": sql(f"""
SELECT {PEERS}, CTP_Facility_Type, Regulate, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos FROM typed_out""",
                    TYPED, RULES, """
said AS (SELECT * FROM rules WHERE Outbrk_Status IS NOT NULL OR Cume_Staff_Pos IS NOT NULL)""", fl_types("said", "typed_out")),
    "peer_fill_type": sql(f"SELECT {PEERS} FROM kinded", TYPED, peer_types("typed", "kinded")),
    "peer_fill_county": sql(f"SELECT {PEERS} FROM countied", TYPED, peer_counties("typed", "countied")),
    "ky_county": sql(f"""
SELECT {REPORT}, CASE ctp_id % 6 WHEN 0 THEN 'JEFFERSON' WHEN 1 THEN 'BULLITT' WHEN 2 THEN 'BULLITTT'
       WHEN 3 THEN 'SHELBY' WHEN 4 THEN 'WOODFORD' ELSE 'BOONE' END AS County FROM panel"""),
    "dq_types": sql("""
SELECT State, check_name AS "check", column_name AS "column", value, count(*) AS n FROM (
  SELECT State, 'date' AS check_name, 'Date' AS column_name,
         CASE WHEN (ctp_id + week) % 37 = 0 THEN '19-1-5' END AS value
  FROM suspect WHERE (ctp_id + week) % 37 = 0 OR (ctp_id + week) % 41 = 0
  UNION ALL SELECT State, 'event_date', 'Outbrk_Open', 'soon' FROM suspect WHERE (ctp_id + week) % 59 = 0
  UNION ALL SELECT State, 'event_date', 'Outbrk_Closed', '13/45/2020' FROM suspect WHERE (ctp_id + week) % 61 = 0
  UNION ALL SELECT State, 'metric', 'Cume_Res_Pos', Cume_Res_Pos FROM suspect
            WHERE Cume_Res_Pos IN ('<11', 'Data Pending')
  UNION ALL SELECT State, 'metric', 'Cume_Staff_Pos', Cume_Staff_Pos FROM suspect
            WHERE Cume_Staff_Pos = '58 *' OR Cume_Staff_Pos LIKE '%.5'
  UNION ALL SELECT State, 'status', 'Outbrk_Status', CASE WHEN (ctp_id + week) % 43 = 0 THEN 'Unknown' ELSE '' END
            FROM suspect WHERE (ctp_id + week) % 43 = 0 OR (ctp_id + week) % 47 = 0)
GROUP BY ALL
UNION ALL
SELECT State, 'state', 'State', 'sheet ' || n_regionkey, n FROM (
  SELECT *, count(*) OVER (PARTITION BY n_regionkey) AS k FROM (
    SELECT n_regionkey, State, count(*) AS n FROM suspect JOIN nation ON n_name = State GROUP BY n_regionkey, State))
WHERE k > 2""", suspect("panel")),
    "dq_open_dupes": sql(f"""
SELECT DISTINCT {", ".join("d." + c.strip() for c in REPORT.split(","))},
       'Multiple open outbreak rows with different data' AS error
FROM dirty d JOIN slots s ON d.State = s.State AND d.ctp_id = s.ctp_id AND d.Date = s.Date
WHERE d.Outbrk_Status = 'OPEN' AND s.open_kinds > 1""", DIRTY),
    "dq_date_dupes": sql(f"""
SELECT {REPORT}, 'duplicate date data' AS error FROM (
  SELECT *, count(*) OVER (PARTITION BY State, Date, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Staff_Pos) AS n FROM coarse)
WHERE n > 1""", """
coarse AS (
  SELECT * REPLACE (
    CASE WHEN ctp_id % 5 <> 0 THEN Cume_Res_Pos % 3 END AS Cume_Res_Pos, Cume_Staff_Pos % 2 AS Cume_Staff_Pos,
    CAST(NULL AS BIGINT) AS Outbrk_Res_Pos,
    CASE WHEN week % 2 = 0 THEN Outbrk_Staff_Pos END AS Outbrk_Staff_Pos) FROM panel)"""),
    "dq_decrease": _decrease("one"),
    "dq_decrease_many_rows": _decrease("panel"),
    "dq_decrease_this_week": _decrease("panel", "AND Date = latest"),
    "recon_federal": recon("SELECT * FROM fed"),
    "recon_national": recon("SELECT * FROM nat"),
    "recon_inner": recon("SELECT * FROM both_sides"),
    "recon_outer": recon("SELECT * FROM either"),
    "recon_latest": recon("SELECT e.* FROM either e, last_week WHERE cms_week = latest OR ctp_cms_week = latest"),
    "recon_unmatched_top5": recon("""
SELECT cms_provider_state, CAST("rank" AS INT) AS "rank", cms_week, cms_provider_name, cms_deaths FROM (
  SELECT *, row_number() OVER (PARTITION BY cms_provider_state
                               ORDER BY cms_deaths DESC NULLS LAST, cms_week, cms_federal_provider_number) AS "rank"
  FROM either WHERE ctp_cms_week IS NULL) WHERE "rank" <= 5"""),
    "recon_divergent": recon("""
SELECT ctp_state, side AS "end", CAST("rank" AS INT) AS "rank", cms_week, ctp_facility, cms_ctp_cases_diff FROM (
  SELECT *, 'lowest' AS side, row_number() OVER (PARTITION BY ctp_state
    ORDER BY cms_ctp_cases_diff, cms_week, cms_federal_provider_number) AS "rank"
  FROM both_sides WHERE cms_ctp_cases_diff_abs > 15
  UNION ALL
  SELECT *, 'highest', row_number() OVER (PARTITION BY ctp_state
    ORDER BY cms_ctp_cases_diff DESC, cms_week, cms_federal_provider_number)
  FROM both_sides WHERE cms_ctp_cases_diff_abs > 15) WHERE "rank" <= 5"""),
    "recon_exports": recon("SELECT * FROM either"),
    "recon_divergent_report": recon("""
SELECT ctp_state, "end", "rank", cms_week, ctp_facility, cms_ctp_cases_diff FROM (
  SELECT *, 'lowest' AS "end", CAST(row_number() OVER (PARTITION BY ctp_state
            ORDER BY cms_ctp_cases_diff, cms_week, cms_federal_provider_number) AS INT) AS "rank" FROM picked
  UNION ALL
  SELECT *, 'highest', CAST(row_number() OVER (PARTITION BY ctp_state
            ORDER BY cms_ctp_cases_diff DESC, cms_week, cms_federal_provider_number) AS INT) FROM picked)
WHERE "rank" <= 5""", """
picked AS (
  SELECT * FROM (SELECT b.* FROM both_sides b, last_week WHERE ctp_cms_week = latest
                 QUALIFY count(*) OVER (PARTITION BY ctp_cms_id) = 1)
  WHERE cms_ctp_cases_diff_abs > 15)"""),
    "recon_divergent_week": recon("""
SELECT ctp_state, ctp_facility, cms_week, cms_ctp_cases_diff, cms_ctp_cases_diff_abs
FROM both_sides, last_week WHERE ctp_cms_week = latest AND cms_ctp_cases_diff_abs > 15"""),
    "recon_unique_ids": recon("""
SELECT * EXCLUDE (k) FROM (SELECT *, count(*) OVER (PARTITION BY ctp_cms_week, ctp_state) AS k FROM nat) WHERE k = 1"""),
    "recon_totals": recon("""
SELECT coalesce(cms_provider_state, ctp_state) AS state,
       CAST(coalesce(sum(ctp_total_deaths), 0) AS BIGINT) AS deaths,
       CAST(coalesce(sum(ctp_total_deaths) FILTER (ctp_ctp_facility_type = 'Nursing Home'), 0) AS BIGINT) AS home_deaths,
       CAST(coalesce(sum(ctp_total_deaths) FILTER (ctp_ctp_facility_type = 'Uncategorized'), 0) AS BIGINT) AS other_deaths,
       CAST(coalesce(sum(cms_deaths) FILTER (ctp_cms_week IS NULL), 0) AS BIGINT) AS unmatched_deaths,
       CAST(coalesce(sum(cms_total_cases) FILTER (ctp_cms_week IS NULL), 0) AS BIGINT) AS unmatched_cases,
       count(*) FILTER (ctp_cms_week IS NULL) AS unmatched_rows
FROM either GROUP BY 1"""),
    "recon_value_counts": recon("""
SELECT cms_week, count(*) AS "rows" FROM either WHERE cms_week IS NOT NULL GROUP BY cms_week"""),
    "recon_counts": recon("""
SELECT 'national_with_case' AS measure, count(DISTINCT ctp_ctp_id) AS n FROM either WHERE ctp_total_cases > 900
UNION ALL SELECT 'national_with_death', count(DISTINCT ctp_ctp_id) FROM either WHERE ctp_total_deaths > 300
UNION ALL SELECT 'federal_with_case', count(DISTINCT cms_federal_provider_number) FROM either WHERE cms_total_cases > 5000
UNION ALL SELECT 'federal_with_death', count(DISTINCT cms_federal_provider_number) FROM either WHERE cms_deaths > 100
UNION ALL SELECT 'states_with_data', count(DISTINCT ctp_state) FROM either WHERE ctp_ctp_id IS NOT NULL
UNION ALL SELECT 'nobody', 0"""),
    "recon_series": recon("""
SELECT ctp_cms_week, ctp_facility, ctp_total_deaths, cms_deaths FROM either
WHERE ctp_facility = 'Supplier#000000003' AND ctp_cms_week IS NOT NULL"""),
    "state_chain_plain": sql(f"SELECT {REPORT} FROM filled", READY, fill("ready", "filled")),
    "state_chain_closing": sql(f"SELECT {REPORT}, last_recorded FROM filled", READY,
                               close("ready", "closed"), fill("closed", "filled")),
    "state_chain_nj": sql(f"SELECT {REPORT}, last_recorded FROM filled", READY, close("ready", "closed"),
                          "recent AS (SELECT * FROM closed WHERE Date >= 19960101)",
                          collapse("recent", "merged"), carry("merged", "carried", 19970101),
                          fill("carried", "filled")),
    "state_chain_wy": sql(f"SELECT {REPORT}, last_recorded FROM done", READY, collapse("ready", "merged"),
                          close("merged", "closed"), fill("closed", "filled"), unknown_closed("filled", "known"),
                          past("known", "summed"), fill("summed", "again"), unknown_closed("again", "done")),
    "state_chain_collapsing": sql(f"SELECT {REPORT} FROM filled", READY, collapse("ready", "merged"),
                                  fill("merged", "filled")),
    "state_chain_merging": sql(f"SELECT {REPORT} FROM filled", thin("panel", "t"), over(DIRTY, "t"),
                               f"merged AS ({no_add(False)})", fill("merged", "filled")),
    "state_chain_listed": sql(f"SELECT {REPORT}, State_Facility_Type FROM filled", thin("panel", "t"), over(DIRTY, "t"),
                              f"merged AS ({no_add(True)})", fill("merged", "filled")),
    "state_chain_marked": sql(f"SELECT {REPORT} FROM filled", thin("panel", "t"), over(MARKED, "t"),
                              f"repaired AS ({LOCF})", fill("repaired", "filled")),
    "state_chain_dropping": sql(f"SELECT {REPORT} FROM filled", thin("panel", "t"),
                                f"kept AS ({over(GAPS, 't')})", fill("kept", "filled")),
    "state_chain_kentucky": sql(f"""
SELECT {REPORT}, CASE ctp_id % 6 WHEN 0 THEN 'JEFFERSON' WHEN 1 THEN 'BULLITT' WHEN 2 THEN 'BULLITTT'
       WHEN 3 THEN 'SHELBY' WHEN 4 THEN 'WOODFORD' ELSE 'BOONE' END AS County FROM filled""", NEW_YEAR,
                                f"undone AS ({UNDONE})", fill("undone", "filled")),
    "state_chain_florida": sql(f"""
SELECT {PEERS}, CTP_Facility_Type, Regulate, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos,
       CASE WHEN Date = own THEN Res_Census END AS Res_Census FROM filled""", thin("panel", "t"), over(TYPED, "t"), RULES, """
said AS (
  SELECT *, Date AS own, CASE WHEN ctp_id % 4 = 0 THEN ctp_id END AS Res_Census FROM rules
  WHERE Outbrk_Status IS NOT NULL OR ctp_id % 4 = 0)""", peer_types("said", "kinded"), peer_counties("kinded", "countied"),
                               fl_types("countied", "finished"), fill("finished", "filled")),
    "state_chain_looked_up": sql(f"SELECT {REPORT}, last_recorded FROM filled", READY,
                                 "known AS (SELECT * REPLACE ('S' || ctp_id AS ctp_id) FROM ready)",
                                 close("known", "closed"), fill("closed", "filled")),
    "finish_panel": sql(f"SELECT {REPORT} FROM known", """
blanked AS (
  SELECT * REPLACE (CASE WHEN (ctp_id + week) % 6 <> 0 THEN Outbrk_Status END AS Outbrk_Status)
  FROM panel WHERE (nation_key + week) % 5 <> 0)""", fill("blanked", "filled"), unknown_closed("filled", "known")),
    "process_states": STATES,
    "job_process": f"""
SELECT State, upper(Facility) AS Facility, 'S' || ctp_id AS ctp_id, Date, Outbrk_Status, Cume_Res_Pos, Cume_Staff_Pos,
       Outbrk_Res_Pos, Outbrk_Staff_Pos, last_recorded FROM ({STATES})""",
    "job_side_reports": sql("""
SELECT 'bad_dates' AS kind, State, Facility, count(*) AS n FROM rows WHERE bad GROUP BY ALL
UNION ALL SELECT 'unknown_facilities', State, Facility, count(*) FROM rows WHERE NOT bad AND ctp_id % 7 = 0 GROUP BY ALL
UNION ALL SELECT 'unmerged_slots', State, Facility, count(*) FROM (
  SELECT State, Facility, Date FROM good WHERE State = 'CO' AND Outbrk_Status = 'OPEN' GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL
UNION ALL SELECT 'early_leavers', State, Facility, 1 FROM ents WHERE gapless AND NOT has_base
UNION ALL SELECT 'panel', State, Facility, count(DISTINCT Date) FROM (
  SELECT State, Facility, Date FROM good
  UNION ALL SELECT e.State, e.Facility, l.d FROM ents e JOIN listed l USING (State) WHERE gapless AND has_base) GROUP BY ALL""", """
rows AS (
  SELECT ctp_id, ['CT', 'CO', 'KY'][nation_key % 3 + 1] AS State, upper(Facility) AS Facility, Date, Outbrk_Status,
         (ctp_id + week) % 29 = 0 AS bad
  FROM (SELECT * FROM panel UNION ALL SELECT * FROM panel WHERE (ctp_id + week) % 13 = 0 AND Outbrk_Status = 'OPEN')),
good AS (SELECT * FROM rows WHERE NOT bad AND ctp_id % 7 <> 0),
listed AS (SELECT DISTINCT State, Date AS d FROM good WHERE State = 'KY' AND Date > 20010921),
ents AS (
  SELECT *, n_new = 0 OR n_new = (SELECT count(*) FROM listed l WHERE l.d >= first_new) AS gapless FROM (
    SELECT State, Facility, ctp_id, min(Date) FILTER (Date > 20010921) AS first_new,
           count(DISTINCT Date) FILTER (Date > 20010921) AS n_new, bool_or(Date = 20010920) AS has_base
    FROM good WHERE State = 'KY' GROUP BY ALL))"""),
    "job_step_counts": STEPS,
    "publish_empty_state": sql("""
SELECT State, CASE WHEN nation_key % 2 = 0 THEN upper(Facility) ELSE Facility END AS Facility, ctp_id, Date, Outbrk_Status,
       Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos
FROM panel WHERE (nation_key + week) % 5 <> 0"""),
    "output_order": sql("""
SELECT State, Facility, ctp_id, Date, row_number() OVER (PARTITION BY State ORDER BY
  Facility, County NULLS LAST, City, kind, ctp_id, Date) AS rank
FROM (SELECT * REPLACE (CASE WHEN ctp_id % 4 = 0 THEN 'Supplier' ELSE Facility END AS Facility),
             CASE WHEN ctp_id % 5 <> 0 THEN 'County ' || (ctp_id % 3) END AS County, 'City ' || (ctp_id % 2) AS City,
             CASE WHEN ctp_id % 3 = 0 THEN 'NH' ELSE 'ALF' END AS kind
      FROM one WHERE (nation_key + week) % 5 <> 0)"""),
    "job_check": sql("""
SELECT State, 'types' AS kind, count(*) AS n FROM dirty WHERE Cume_Staff_Pos = '<11' GROUP BY State
UNION ALL
SELECT State, 'dupes', count(*) FROM (
  SELECT State, count(*) FILTER (Outbrk_Status = 'OPEN') OVER (PARTITION BY ctp_id, Date) AS n, Outbrk_Status FROM d)
WHERE n > 1 AND Outbrk_Status = 'OPEN' GROUP BY State
UNION ALL
SELECT State, 'date_data_dupes', count(*) FROM (
  SELECT State, count(*) OVER (PARTITION BY State, Date, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos,
                               Outbrk_Staff_Pos) AS n FROM d) WHERE n > 1 GROUP BY State
UNION ALL
SELECT State, 'decreased_cumulative',
       CAST(sum(CASE WHEN res < was_res THEN 1 ELSE 0 END + CASE WHEN staff <> -1 AND staff < was_staff THEN 1 ELSE 0 END) AS BIGINT)
FROM seq WHERE res < was_res OR (staff <> -1 AND staff < was_staff) GROUP BY State""", over(DIRTY, "one"), DISTINCT),
    "check_findings": sql("""
SELECT State, 'types' AS kind, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT State, count(*) AS n FROM dirty WHERE Cume_Staff_Pos = '<11' GROUP BY State
  UNION ALL SELECT State, n FROM (
    SELECT State, count(*) AS n, count(*) OVER (PARTITION BY any_value(nation_key) % 5) AS k FROM dirty GROUP BY State)
  WHERE k > 2) GROUP BY State
UNION ALL
SELECT State, 'dupes', count(*) FROM (
  SELECT State, count(*) FILTER (Outbrk_Status = 'OPEN') OVER (PARTITION BY ctp_id, Date) AS n, Outbrk_Status FROM d)
WHERE n > 1 AND Outbrk_Status = 'OPEN' GROUP BY State
UNION ALL
SELECT State, 'date_data_dupes', count(*) FROM (
  SELECT State, count(*) OVER (PARTITION BY State, Date, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos,
                               Outbrk_Staff_Pos) AS n FROM d) WHERE n > 1 GROUP BY State
UNION ALL
SELECT State, 'decreased_cumulative',
       CAST(sum(CASE WHEN res < was_res THEN 1 ELSE 0 END + CASE WHEN staff <> -1 AND staff < was_staff THEN 1 ELSE 0 END) AS BIGINT)
FROM seq WHERE res < was_res OR (staff <> -1 AND staff < was_staff) GROUP BY State""", DIRTY, DISTINCT),
    "written_and_read": sql("""
SELECT State, CASE WHEN ctp_id % 7 = 0 THEN 'a "b", ' || Facility || chr(10) || 'c' ELSE Facility END AS Facility,
       ctp_id, Date, CASE WHEN (ctp_id + week) % 6 = 0 THEN ' ' WHEN (ctp_id + week) % 5 <> 0 THEN Outbrk_Status END
       AS Outbrk_Status, Cume_Res_Pos, Cume_Staff_Pos, Outbrk_Res_Pos, Outbrk_Staff_Pos
FROM panel WHERE (nation_key + week) % 5 <> 0"""),
}
