"""SQL for DuckDB that computes each registered query in another way.

Adjacency is a self-join on row numbers, flows are joins and set differences per period
against a dense calendar, and coverage is a count of all users up to the period.
"""

from __future__ import annotations

from airwave.functions.calendar import GRAINS
from airwave.sources.logs import HEARTBEAT, KEY_FIELDS, LIVE, OPEN

LIVE_DAYS = tuple(f"(SELECT CAST({f}(ts) AS DATE) FROM events)" for f in ("min", "max"))
DEMAND_DAYS = tuple(f"(SELECT CAST({f}(o_orderdate) AS DATE) FROM orders)" for f in ("min", "max"))

CHANNEL_RAW = (
    "CASE WHEN k % 17 = 0 THEN '' ELSE 'CH' || (k % 20) "
    "|| CASE WHEN k % 3 = 0 THEN '(pay)' ELSE '' END END"
)
PROGRAM_RAW = "CASE WHEN k % 29 = 0 THEN 'null' ELSE 'P' || k END"


def channel(raw: str) -> str:
    return f"CASE WHEN {raw} IN ('', 'null') THEN '?' ELSE split_part({raw}, '(', 1) END"


def program(raw: str) -> str:
    return f"CASE WHEN {raw} IN ('', 'null') THEN '?' ELSE {raw} END"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(x: str, y: str) -> str:
    return f"({dbl(x)} / nullif({dbl(y)}, 0))"


def r4(x: str) -> str:
    """Round half up on the digits that the double prints, as report text does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), 4) AS DOUBLE)"


def mins(x: str) -> str:
    return f"({dbl(x)} / CAST(60 AS DOUBLE))"


def month_of(day: str) -> str:
    return f"CAST(year({day}) * 100 + month({day}) AS INTEGER)"


def week_of(day: str) -> str:
    return f"CAST(isoyear({day}) * 100 + week({day}) AS INTEGER)"


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


EV = (
    "ev AS (SELECT event_id, user_id AS uid, date_trunc('second', ts) AS ts, event_type, value, "
    "CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)"
)

LIVE_ROWS = (
    "live AS (SELECT event_id, uid, ts, "
    f"{channel(CHANNEL_RAW)} AS channel_name, {program(PROGRAM_RAW)} AS program_name "
    "FROM ev WHERE event_type IN ('view', 'click', 'purchase'))"
)

SHUT = """
power AS (SELECT event_id, uid, ts, event_type = 'signup' AS opens,
       row_number() OVER (PARTITION BY uid ORDER BY ts, event_type = 'signup', event_id) AS rn
  FROM ev WHERE event_type IN ('signup', 'error')),
shut AS (SELECT n.event_id, n.uid, '_' AS channel_name, '_' AS program_name,
       p.ts + to_minutes((CAST(right(CAST(n.uid AS VARCHAR), 6) AS BIGINT) * 31
                          + CAST(epoch(p.ts) AS BIGINT)) % 10) AS ts
  FROM power n JOIN power p ON p.uid = n.uid AND p.rn = n.rn - 1 WHERE n.opens)"""

DWELL = """
stream AS (SELECT event_id, uid, ts, channel_name, program_name, 0 AS off FROM live
  UNION ALL SELECT event_id, uid, ts, channel_name, program_name, 1 AS off FROM shut),
lined AS (SELECT *, row_number() OVER (ORDER BY uid, ts, off, event_id) AS rn FROM stream),
dwell AS (SELECT a.event_id, a.uid, a.ts, a.channel_name, a.program_name,
       CAST(date_diff('second', a.ts, b.ts) AS BIGINT) AS seconds
  FROM lined a JOIN lined b ON b.rn = a.rn + 1 AND b.uid = a.uid
 WHERE a.channel_name <> '_' AND date_diff('second', a.ts, b.ts) BETWEEN 5 AND 36000)"""

HOURS = f"""
hours AS (SELECT uid, {month_of('ts')} AS month, {week_of('ts')} AS week, CAST(ts AS DATE) AS day,
       CAST(hour(ts) AS INTEGER) AS hour, channel_name, program_name,
       CAST(sum(seconds) AS BIGINT) AS seconds
  FROM dwell GROUP BY ALL)"""

PIECES = f"""
cut AS (SELECT uid, channel_name, program_name, seconds, i,
       day + to_hours(hour + i) AS began
  FROM hours, LATERAL (SELECT unnest(range(0, greatest((seconds + 3599) // 3600, 1))) AS i)),
pieces AS (SELECT uid, {month_of('began')} AS month, {week_of('began')} AS week, CAST(began AS DATE) AS day,
       CAST(hour(began) AS INTEGER) AS hour, channel_name, program_name,
       CAST(least(3600, seconds - 3600 * i) AS BIGINT) AS seconds FROM cut)"""

LIVE_ALL = ", ".join([EV, LIVE_ROWS, SHUT, DWELL, HOURS])
LIVE_PIECES = f"{LIVE_ALL}, {PIECES}"

CHANNELS = (
    "dict AS (SELECT 'CH' || i AS channel_name, "
    "CASE WHEN i < 7 THEN '央视频道' ELSE '卫视频道' END AS channel_type "
    "FROM (SELECT unnest(range(15)) AS i))"
)

DEMAND_ROWS = f"""
demand AS (SELECT o_custkey AS uid, CAST(floor(l_quantity * 60) AS BIGINT) AS seconds,
       CAST(o_orderdate AS DATE) AS day, l_partkey AS show_name,
       {week_of('o_orderdate')} AS week, {month_of('o_orderdate')} AS month,
       l_returnflag = 'N' AS flag
  FROM lineitem, orders WHERE l_orderkey = o_orderkey)"""

PARTS = (
    "dict AS (SELECT p_partkey AS show_name, min(p_type) AS show_type FROM part GROUP BY 1 "
    "HAVING min(p_type) IN ('ECONOMY', 'PROMO'))"
)

DEMAND_HOURS = f"""
demand AS (SELECT uid, CAST(floor(value * 60) AS BIGINT) AS seconds, CAST(ts AS DATE) AS day,
       'P' || k AS show_name, CAST(hour(ts) AS INTEGER) AS hour, {week_of('ts')} AS week,
       {month_of('ts')} AS month, event_type = 'purchase' AS flag
  FROM ev WHERE event_type IN ('purchase', 'signup'))"""

HOUR_SHOWS = (
    "dict AS (SELECT 'P' || i AS show_name, "
    "CASE i % 3 WHEN 0 THEN '电影' ELSE '电视剧' END AS show_type "
    "FROM (SELECT unnest(range(100)) AS i) WHERE i % 3 < 2)"
)

BASE = "base AS (SELECT DISTINCT c_custkey AS uid FROM customer WHERE c_mktsegment = 'BUILDING')"
NOBODY = "SELECT CAST(NULL AS BIGINT) AS uid WHERE false"


def start_of(grain: str, day: str) -> str:
    return f"CAST(date_trunc('{grain}', {day}) AS DATE)"


def key_of(grain: str, start: str) -> str:
    return {"day": start, "week": week_of(start), "month": month_of(start)}[grain]


def flow(
    source: str,
    grain: str,
    days: tuple[str, str],
    *,
    name: str = "summary",
    cover: str = NOBODY,
    previous: str = NOBODY,
    look_back: bool = False,
    demand: bool = False,
) -> str:
    """CTEs ending in ``name``: one row per calendar period, keyed by the grain."""
    n, step = name, f"INTERVAL 1 {grain}"
    first, last = (start_of(grain, day) for day in days)
    back = f" UNION SELECT uid FROM {n}_all WHERE p = {first} - {step}" if look_back else ""
    extra = ", CAST(count_if(flag) AS BIGINT) AS request_times, count(DISTINCT show_name) AS shows" if demand else ""
    outer = ", coalesce(request_times, 0) AS request_times" if demand else ""
    tail = ", coalesce(shows, 0) AS all_show_num" if demand else ""
    return f"""
{n}_all AS (SELECT *, {start_of(grain, 'day')} AS p FROM {source}),
{n}_in AS (SELECT * FROM {n}_all WHERE p BETWEEN {first} AND {last}),
{n}_cal AS (SELECT CAST(unnest(generate_series({first}, {last}, {step})) AS DATE) AS p),
{n}_now AS (SELECT DISTINCT p, uid FROM {n}_in),
{n}_old AS (SELECT CAST(p + {step} AS DATE) AS p, uid FROM {n}_now
  UNION SELECT {first} AS p, uid FROM ({previous}{back})),
{n}_known AS (SELECT p, uid FROM {n}_now UNION ALL SELECT DATE '0001-01-01', uid FROM ({cover})),
{n}_cover AS (SELECT c.p, count(DISTINCT k.uid) AS n FROM {n}_cal c
  LEFT JOIN {n}_known k ON k.p <= c.p GROUP BY c.p),
{n}_enter AS (SELECT p, count(*) AS n FROM (SELECT * FROM {n}_now EXCEPT SELECT * FROM {n}_old)
  GROUP BY p),
{n}_leave AS (SELECT p, count(*) AS n FROM (SELECT * FROM {n}_old EXCEPT SELECT * FROM {n}_now)
  GROUP BY p),
{n}_last AS (SELECT p, count(*) AS n FROM {n}_old GROUP BY p),
{n}_sums AS (SELECT p, count(DISTINCT uid) AS users, sum(seconds) AS seconds{extra}
  FROM {n}_in GROUP BY p),
{n} AS (SELECT {key_of(grain, 'c.p')} AS {grain},
       coalesce(s.users, 0) AS user_num, v.n AS cover_user_num,
       coalesce(e.n, 0) AS user_in_num, coalesce(l.n, 0) AS user_out_num,
       coalesce(o.n, 0) AS last_user_num{outer},
       {mins('coalesce(s.seconds, 0)')} AS time_in_use{tail}
  FROM {n}_cal c JOIN {n}_cover v ON v.p = c.p
  LEFT JOIN {n}_sums s ON s.p = c.p LEFT JOIN {n}_enter e ON e.p = c.p
  LEFT JOIN {n}_leave l ON l.p = c.p LEFT JOIN {n}_last o ON o.p = c.p)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def select_tagged(grain: str, demand: bool = False, name: str = "summary") -> str:
    more = ", request_times" if demand else ""
    shows = ", all_show_num" if demand else ""
    return (
        f"SELECT '{grain}' AS grain, {text(grain)} AS period, user_num, cover_user_num, "
        f"user_in_num, user_out_num, last_user_num{more}, time_in_use{shows} FROM {name}"
    )


def demand_flow(grain: str) -> str:
    return flow("demand", grain, DEMAND_DAYS, cover="SELECT uid FROM base", look_back=True,
                demand=True)


NO_REQUESTS = (
    "CAST(0 AS BIGINT) AS request_times, CAST(0 AS DOUBLE) AS request_times_avg, "
    "CAST(0 AS DOUBLE) AS request_one"
)


def shown_key(grain: str) -> str:
    return f"{text('day')} AS day" if grain in ("day", "hour") else grain


def select_summary(grain: str, user_type: int, demand: bool, name: str = "summary") -> str:
    requests = NO_REQUESTS
    if demand:
        requests = (
            f"request_times, {r4(div('request_times', 'user_num'))} AS request_times_avg, "
            f"{r4(div('time_in_use', 'request_times'))} AS request_one"
        )
    return f"""SELECT {shown_key(grain)}, {user_type} AS user_type, user_num,
       {r4(div('user_num', 'cover_user_num'))} AS cover_pct,
       {r4(div('user_num - last_user_num', 'last_user_num'))} AS growth_pct,
       user_in_num, user_out_num, {r4('time_in_use')} AS time_in_use,
       {r4(div('time_in_use', 'user_num'))} AS time_in_use_avg, {requests}
  FROM {name}"""


def hour_totals(source: str, cover: str, demand: bool, name: str = "totals") -> str:
    extra = ", count(DISTINCT show_name) AS all_show_num, CAST(count_if(flag) AS BIGINT) AS n_requests" if demand else ""
    return f"""
{name}_g AS (SELECT day, hour, count(DISTINCT uid) AS user_num, {mins('sum(seconds)')} AS time_in_use{extra}
  FROM {source} GROUP BY day, hour),
{name} AS (SELECT g.*, c.cover_user_num FROM {name}_g g LEFT JOIN {cover} c ON c.day = g.day)"""


def select_hour_summary(user_type: int, demand: bool, name: str = "totals") -> str:
    requests = NO_REQUESTS
    if demand:
        count = "nullif(n_requests, 0)"
        requests = (
            f"{count} AS request_times, {r4(div(count, 'user_num'))} AS request_times_avg, "
            f"least(CAST(60 AS DOUBLE), {r4('coalesce(' + div('time_in_use', count) + ', 0)')}) "
            "AS request_one"
        )
    return f"""SELECT {text('day')} AS day, hour, {user_type} AS user_type, user_num,
       {r4(div('user_num', 'cover_user_num'))} AS cover_pct, {r4('time_in_use')} AS time_in_use,
       {r4(div('time_in_use', 'user_num'))} AS time_in_use_avg, {requests}
  FROM {name}"""


def select_groups(
    source: str, totals: str, grain: str, items: list[str], kind: str, prefix: str,
    names: str, show_share: bool = False,
) -> str:
    """KPI rows: join first, group after; the library works the other way round."""
    keys = GRAINS[grain].keys
    item = "channel_name" if kind == "channel_type" else "show_name"
    on = " AND ".join(f"t.{k} = g.{k}" for k in keys)
    shown = ", ".join(f"{text('g.day')} AS day" if k == "day" else f"g.{k}" for k in keys)
    group = ", ".join([f"s.{k}" for k in keys] + items)
    mine, length = mins("g.seconds"), GRAINS[grain].minutes
    against = "t.cover_user_num" if grain == "hour" else "t.user_num"
    index = f"{div(f'({mine} / {dbl(str(length))})', 't.cover_user_num')} * CAST(10000 AS DOUBLE)"
    share = ""
    if show_share:
        share = f", {r4(div('g.shows', 't.all_show_num'))} AS show_num_pct"
    return f"""SELECT {shown}, {names}, {r4(index)} AS user_index,
       {r4(div(mine, 't.time_in_use'))} AS market_pct,
       {r4(div('g.users', against))} AS cover_pct,
       {r4(div(mine, 'g.users'))} AS time_in_use_avg,
       {r4(mine)} AS {prefix}_time_in_use, g.users AS {prefix}_user_num{share},
       {r4('t.time_in_use')} AS time_in_use, t.user_num AS user_num
  FROM (SELECT {group}, count(DISTINCT s.uid) AS users, sum(s.seconds) AS seconds,
               count(DISTINCT s.{item}) AS shows
          FROM {source} s JOIN dict d ON d.{item} = s.{item} GROUP BY {group}) g
  LEFT JOIN {totals} t ON {on}"""


def live_summary(grain: str, name: str = "summary") -> str:
    return flow("hours", grain, LIVE_DAYS, name=name)


def live_parts(grain: str) -> tuple[str, str, str]:
    """CTEs, detail table and totals table of a live report."""
    if grain == "hour":
        ctes = [LIVE_PIECES, CHANNELS, live_summary("day"), hour_totals("pieces", "summary", False)]
        return ", ".join(ctes), "pieces", "totals"
    return ", ".join([LIVE_ALL, CHANNELS, live_summary(grain)]), "hours", "summary"


HOUR_REQUESTS = (
    "seen AS (SELECT DISTINCT uid, day, hour, seconds, show_name, flag FROM demand)"
)


def demand_hour_flow(grain: str, name: str = "summary") -> str:
    return flow("demand", grain, LIVE_DAYS, name=name, demand=True)


def demand_parts(grain: str) -> tuple[str, str, str]:
    if grain == "hour":
        ctes = [EV, DEMAND_HOURS, HOUR_SHOWS, demand_hour_flow("day"), HOUR_REQUESTS,
                hour_totals("seen", "summary", True)]
        return ", ".join(ctes), "seen", "totals"
    seen = f"seen AS (SELECT DISTINCT uid, {grain}, seconds, show_name FROM demand)"
    return ", ".join([DEMAND_ROWS, BASE, PARTS, demand_flow(grain), seen]), "seen", "summary"


def demand_type(grain: str) -> str:
    ctes, source, totals = demand_parts(grain)
    return with_(ctes, select_groups(
        source, totals, grain, ["d.show_type"], "show_type", "show", "g.show_type", True))


def demand_show(grain: str) -> str:
    ctes, source, totals = demand_parts(grain)
    return with_(ctes, select_groups(
        source, totals, grain, ["s.show_name", "d.show_type"], "show_type", "show",
        "g.show_name, g.show_type"))


def demand_summary_report(grain: str) -> str:
    ctes, _, _ = demand_parts(grain)
    if grain == "hour":
        return with_(ctes, select_hour_summary(2, True))
    return with_(ctes, select_summary(grain, 2, True))


def one_week_down(report: str) -> str:
    monday = (
        "(date_trunc('week', make_date(CAST(week // 100 AS BIGINT), 1, 4)) "
        "+ to_days(CAST((week % 100 - 1) * 7 - 7 AS INTEGER)))"
    )
    return f"SELECT * REPLACE ({week_of(monday)} AS week) FROM ({report})"


def overview(grain: str) -> str:
    if grain == "hour":
        ctes = ", ".join([
            LIVE_PIECES, live_summary("day", "lsum"), hour_totals("pieces", "lsum", False, "lt"),
            DEMAND_HOURS, demand_hour_flow("day", "dsum"), HOUR_REQUESTS,
            hour_totals("seen", "dsum", True, "dt"),
            f"l AS ({select_hour_summary(1, False, 'lt')})",
            f"d AS ({select_hour_summary(2, True, 'dt')})",
        ])
        used = "(l.time_in_use + d.time_in_use)"
        return with_(ctes, f"""SELECT l.day, l.hour, 0 AS user_type, CAST(0 AS BIGINT) AS user_num,
       CAST(0 AS DOUBLE) AS cover_pct, {r4(used)} AS time_in_use,
       {r4(div(used, '(l.user_num + d.user_num)'))} AS time_in_use_avg, {NO_REQUESTS}
  FROM l JOIN d ON d.day = l.day AND d.hour = l.hour""")
    columns = ["user_num", "cover_user_num", "user_in_num", "user_out_num", "last_user_num",
               "time_in_use"]
    sums = ", ".join(f"l.{c} + d.{c} AS {c}" for c in columns)
    ctes = ", ".join([
        LIVE_ALL, live_summary(grain, "l"), DEMAND_HOURS, demand_hour_flow(grain, "d"),
        f"both_ AS (SELECT l.{grain}, {sums} FROM l JOIN d ON d.{grain} = l.{grain})",
    ])
    return with_(ctes, select_summary(grain, 0, False, "both_"))


RAW_UID = "CASE WHEN k % 13 = 0 THEN uid + 100000 ELSE uid + 80000000000 END"
PARSED = f"""
raw AS (SELECT CASE event_type WHEN 'signup' THEN '{OPEN}' WHEN 'error' THEN '{HEARTBEAT}'
            ELSE '{LIVE}' END || ';' || strftime(ts, '%Y%m%d%H%M%S') || ';' || ({RAW_UID})
         || ';a;;b;c;' || ({CHANNEL_RAW}) || ';' || ({PROGRAM_RAW}) || ';;'
         || CASE WHEN k % 19 = 0 THEN '' ELSE 'z' END AS line FROM ev),
log AS (SELECT line, string_split(regexp_replace(line, ';*$', ''), ';') AS f FROM raw),
parsed AS (SELECT f[1] AS code, f[2] AS time_text, f[3] AS uid, f[8] AS channel_raw,
       f[9] AS program_raw, CAST(len(f) AS INTEGER) AS n_fields, line FROM log)"""

SOUND = (
    "length(time_text) = 14 AND length(uid) > 6 "
    f"AND TRY_CAST(left(time_text, 6) AS INTEGER) BETWEEN {month_of(LIVE_DAYS[0])} AND {month_of(LIVE_DAYS[1])}"
)
LOG_TIME = text("strptime(time_text, '%Y%m%d%H%M%S')")


def routed() -> str:
    codes = sorted(code for group in KEY_FIELDS.values() for code in group)
    codes.append("0301|9999|99")
    listed = ", ".join(f"'{c}'" for c in codes)
    fields = " || ';' || ".join(
        f"(CASE WHEN (k + {i}) % 11 = 0 THEN 0 ELSE uid * 10 + {i} END)" for i in range(1, 9)
    )
    branches = " ".join(
        "WHEN f[1] IN ({}) THEN [f[{}], f[{}]]".format(
            ", ".join(f"'{c}'" for c in group), first + 1, second + 1
        )
        for (first, second), group in KEY_FIELDS.items()
    )
    return with_(
        f"""{EV}, raw AS (SELECT [{listed}][k % {len(codes)} + 1] || ';' || {fields} AS line FROM ev),
keyed AS (SELECT line, CASE {branches} END AS key
  FROM (SELECT line, string_split(line, ';') AS f FROM raw))""",
        """SELECT key[1] AS key_1, key[2] AS key_2, line FROM keyed
 WHERE key[1] <> '' AND key[1] <> '0' AND key[2] <> '' AND key[2] <> '0'""",
    )


def hours_text(name: str = "hours") -> str:
    return (
        f"SELECT uid, month, week, {text('day')} AS day, hour, channel_name, program_name, seconds "
        f"FROM {name}"
    )


def prepared(grain: str) -> str:
    return with_(f"{LIVE_ALL}, {live_summary(grain)}", select_tagged(grain))


def oracle_sql() -> dict[str, str]:
    moved = """SELECT CAST(day AS VARCHAR) AS day, count(*) AS {name} FROM (
  SELECT DISTINCT day + {a} AS day, uid FROM hours EXCEPT SELECT day + {b} AS day, uid FROM hours)
 WHERE day <= {last} GROUP BY 1"""
    sql = {
        "parse_raw_log": with_(f"{EV}, {PARSED}", "SELECT * FROM parsed"),
        "scan_live": with_(LIVE_ALL, hours_text().replace("uid,", f"{text('uid')} AS uid,")),
        "scan_demand": with_(
            f"{EV}, {DEMAND_HOURS}",
            f"SELECT {text('uid')} AS uid, seconds, {text('day')} AS day, show_name, hour, week, "
            "month, flag FROM demand",
        ),
        "scan_summary_grain": with_(
            f"{LIVE_ALL}, {live_summary('week')}",
            "SELECT week, user_num, cover_user_num, user_in_num, user_out_num, last_user_num, "
            "CAST(printf('%.6f', time_in_use) AS DOUBLE) AS time_in_use FROM summary",
        ),
        "filter_live": with_(
            f"{EV}, {PARSED}",
            f"SELECT DISTINCT uid, {LOG_TIME} AS ts, {channel('channel_raw')} AS channel_name, "
            f"{program('program_raw')} AS program_name FROM parsed "
            f"WHERE n_fields = 11 AND code = '{LIVE}' AND {SOUND}",
        ),
        "filter_power_events": with_(
            f"{EV}, {PARSED}",
            f"SELECT uid, {LOG_TIME} AS ts, code = '{OPEN}' AS opens FROM parsed "
            f"WHERE code IN ('{OPEN}', '{HEARTBEAT}') AND {SOUND}",
        ),
        "monthly_users_filtered": with_(
            f"{EV}, {PARSED}",
            "SELECT CAST(left(time_text, 6) AS INTEGER) AS month, count(DISTINCT uid) AS user_num "
            f"FROM parsed WHERE n_fields >= 9 AND code = '{LIVE}' AND {SOUND} GROUP BY 1",
        ),
        "filter_period_range": with_(
            DEMAND_ROWS,
            f"SELECT uid, seconds, {text('day')} AS day, show_name, week, month, flag FROM demand "
            "WHERE day >= DATE '1995-11-01' AND day < DATE '1997-03-01'",
        ),
        "clean_channel": with_(
            EV,
            f"SELECT event_id, {channel(f'({CHANNEL_RAW})')} AS channel_name, "
            f"{program(f'({PROGRAM_RAW})')} AS program_name FROM ev",
        ),
        "calendar_keys": (
            "SELECT id, CAST(strftime(ts, '%Y%m') AS INTEGER) AS month, "
            "CAST(strftime(ts, '%G%V') AS INTEGER) AS week, strftime(ts, '%Y-%m-%d') AS day, "
            "CAST(strftime(ts, '%H') AS INTEGER) AS hour FROM ("
            "SELECT o_orderkey AS id, o_orderdate AS ts FROM orders "
            "UNION ALL SELECT event_id, ts FROM events)"
        ),
        "route_events": routed(),
        "route_events_sorted": routed(),
        "shutdown_times": with_(
            f"{EV}, {SHUT}",
            f"SELECT uid, {text('ts')} AS ts, channel_name, program_name, event_id FROM shut",
        ),
        "dwell_time": with_(
            ", ".join([EV, LIVE_ROWS, SHUT, DWELL]),
            f"SELECT event_id, uid, {text('ts')} AS ts, channel_name, program_name, seconds FROM dwell",
        ),
        "dwell_hourly": with_(LIVE_ALL, hours_text()),
        "split_dwell_hours": with_(LIVE_PIECES, hours_text("pieces")),
        "live_prepare_seeded": with_(
            f"{LIVE_ALL}, {BASE}, " + flow(
                "hours", "day", LIVE_DAYS, cover="SELECT uid FROM base",
                previous="SELECT uid FROM base ORDER BY uid LIMIT 20",
            ),
            select_tagged("day"),
        ),
        "demand_prepare_look_back": with_(
            f"{DEMAND_ROWS}, {BASE}, " + flow(
                "demand", "month", ("DATE '1995-12-01'", DEMAND_DAYS[1]), cover="SELECT uid FROM base",
                look_back=True, demand=True,
            ),
            select_tagged("month", demand=True),
        ),
        "cover_users_day": with_(
            f"{LIVE_ALL}, {live_summary('day')}",
            f"SELECT {text('day')} AS day, cover_user_num FROM summary",
        ),
        "users_by_period": with_(
            LIVE_ALL,
            f"SELECT {text('day')} AS day, count(*) AS user_num "
            "FROM (SELECT DISTINCT day, uid FROM hours) GROUP BY day",
        ),
        "shows_by_period": with_(
            DEMAND_ROWS,
            "SELECT month, count(*) AS show_num "
            "FROM (SELECT DISTINCT month, show_name FROM demand) GROUP BY month",
        ),
        "user_in_day": with_(
            LIVE_ALL, moved.format(name="user_in_num", a=0, b=1, last=LIVE_DAYS[1])
        ),
        "user_out_day": with_(
            LIVE_ALL, moved.format(name="user_out_num", a=1, b=0, last=LIVE_DAYS[1])
        ),
        "enrich_type": with_(
            f"{LIVE_ALL}, {CHANNELS}",
            f"SELECT channel_name, uid, month, week, {text('day')} AS day, hour, program_name, "
            "seconds, channel_type FROM hours LEFT JOIN dict USING (channel_name)",
        ),
        "dedupe_demand": with_(
            DEMAND_ROWS, "SELECT uid, month, seconds, show_name FROM demand GROUP BY ALL"
        ),
        "request_times_hour": with_(
            f"{EV}, {DEMAND_HOURS}, {HOUR_REQUESTS}",
            f"SELECT {text('day')} AS day, hour, count(*) AS request_times FROM seen "
            "WHERE flag GROUP BY 1, 2",
        ),
        "fix_week": one_week_down(demand_summary_report("week")),
        "fix_week_type": one_week_down(demand_type("week")),
        "fix_week_show": one_week_down(demand_show("week")),
        "extract_uids": with_(
            LIVE_ALL, "SELECT DISTINCT uid FROM hours WHERE month IN (202401, 202402) "
            "ORDER BY uid LIMIT 100",
        ),
        "distinct_channels": with_(
            LIVE_ALL, "SELECT DISTINCT channel_name FROM hours WHERE month > 202312 AND month < 202402"
        ),
        "dictionary_sorted": (
            "SELECT DISTINCT p_partkey AS show_name, p_type AS show_type FROM part"
        ),
        "all_time_channel": with_(
            f"{EV}, {CHANNELS}, "
            "log AS (SELECT uid, CAST(floor(value * 60) AS DOUBLE) AS used, CAST(ts AS DATE) AS date, "
            "CAST(hour(ts) AS INTEGER) AS time_frame, 'CH' || (k % 20) AS channel_name FROM ev), "
            "frames AS (SELECT date, time_frame, sum(used) AS all_time_use, "
            "count(DISTINCT uid) AS all_user_num FROM log GROUP BY 1, 2)",
            f"SELECT {text('l.date')} AS date, l.time_frame, l.channel_name, channel_type, "
            "avg(used) AS time_use_avg, sum(used) AS time_use_sum, "
            "count(DISTINCT uid) AS user_num, all_time_use, all_user_num "
            "FROM log l JOIN frames f ON f.date = l.date AND f.time_frame = l.time_frame "
            "LEFT JOIN dict d ON d.channel_name = l.channel_name GROUP BY ALL",
        ),
        "partition_by_viewer": with_(
            f"{EV}, {LIVE_ROWS}",
            "SELECT CAST(CAST(right(CAST(uid AS VARCHAR), 6) AS BIGINT) % 16 AS INTEGER) AS slot, "
            "count(*) AS n_rows, count(DISTINCT uid) AS user_num FROM live GROUP BY 1",
        ),
    }
    ctes, source, totals = live_parts("hour")
    sql["live_show_hour"] = with_(ctes, select_groups(
        source, totals, "hour", ["s.program_name", "s.channel_name", "d.channel_type"],
        "channel_type", "show", "g.program_name AS show_name, g.channel_name, g.channel_type"))
    for grain in GRAINS:
        ctes, source, totals = live_parts(grain)
        if grain == "hour":
            sql["live_summary_hour"] = with_(ctes, select_hour_summary(1, False))
        else:
            sql[f"live_summary_{grain}"] = with_(ctes, select_summary(grain, 1, False))
            sql[f"live_prepare_{grain}"] = prepared(grain)
            sql[f"demand_prepare_{grain}"] = with_(
                f"{DEMAND_ROWS}, {BASE}, {demand_flow(grain)}", select_tagged(grain, demand=True)
            )
        sql[f"live_type_{grain}"] = with_(ctes, select_groups(
            source, totals, grain, ["d.channel_type"], "channel_type", "channel", "g.channel_type"))
        sql[f"live_channel_{grain}"] = with_(ctes, select_groups(
            source, totals, grain, ["s.channel_name", "d.channel_type"], "channel_type", "channel",
            "g.channel_name, g.channel_type"))
        sql[f"demand_summary_{grain}"] = demand_summary_report(grain)
        sql[f"demand_type_{grain}"] = demand_type(grain)
        sql[f"demand_show_{grain}"] = demand_show(grain)
        sql[f"overview_{grain}"] = overview(grain)
    for name in ("dwell_time", "cover_users_day"):
        sql[f"{name}_batches"] = sql[name]
    return sql
