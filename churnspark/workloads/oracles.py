"""DuckDB SQL that states each query's result over the same Parquet tables."""

from __future__ import annotations

import math

DIGITS = 6

# Stated again here, so that an error in the package's own tables shows as a difference.
# States and agents that the users of the derived log have in turn, the first registration.
STATES = ("CA", "TX", "NY-NJ", "IL", "WA", "FL", "AZ", "ZZ")
AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1",
)
REGISTRATION_START_MS = 1_701_388_800_000
# State -> region.
STATE_REGIONS = {
    "AK": "West", "AL": "South", "AR": "South", "AZ": "Southwest", "CA": "West", "CO": "West", "CT": "Northeast",
    "DC": "South", "DE": "South", "FL": "South", "GA": "South", "HI": "West", "IA": "Midwest", "ID": "West",
    "IL": "Midwest", "IN": "Midwest", "KS": "Midwest", "KY": "South", "LA": "South", "MA": "Northeast", "MD": "South",
    "ME": "Northeast", "MI": "Midwest", "MN": "Midwest", "MO": "Midwest", "MS": "South", "MT": "West", "NC": "South",
    "ND": "Midwest", "NE": "Midwest", "NH": "Northeast", "NJ": "Northeast", "NM": "Southwest", "NV": "West",
    "NY": "Northeast", "OH": "Midwest", "OK": "South", "OR": "West", "PA": "Northeast", "RI": "Northeast",
    "SC": "South", "SD": "Midwest", "TN": "South", "TX": "South", "UT": "West", "VA": "South", "VT": "Northeast",
    "WA": "West", "WI": "Midwest", "WV": "South", "WY": "West",
}
# Log column -> type.
LOG_COLUMNS = {
    "artist": "text", "auth": "text", "gender": "text", "ts": "number", "userId": "text", "sessionId": "number",
    "page": "text", "method": "text", "status": "number", "level": "text", "itemInSession": "number",
    "location": "text", "userAgent": "text", "lastName": "text", "firstName": "text", "song": "text",
    "registration": "number", "length": "double",
}
# Counted page -> column.
PAGE_COLUMNS = {
    "NextSong": "num_nextsong", "Thumbs Up": "num_thumbs_up", "Thumbs Down": "num_thumbs_down",
    "Add to Playlist": "num_add_to_playlist", "Add Friend": "num_add_friend", "Error": "num_error", "Help": "num_help",
    "Submit Upgrade": "num_submit_upgrade", "Submit Downgrade": "num_submit_downgrade",
    "Roll Advert": "num_roll_advert", "Logout": "num_logout", "Downgrade": "num_downgrade", "Upgrade": "num_upgrade",
    "Settings": "num_settings", "About": "num_about", "Save Settings": "num_save_settings",
}
# Columns without which an event is dropped.
REQUIRED = ("userId", "firstName", "lastName", "location", "userAgent", "registration", "gender")


def _region_case() -> str:
    """Branches of a CASE over an upper-cased state."""
    return " ".join(f"WHEN '{state}' THEN '{region}'" for state, region in STATE_REGIONS.items())


def _missing(column: str, kind: str) -> str:
    more = {"text": f""" OR "{column}" = ''""", "double": f' OR isnan("{column}")'}.get(kind, "")
    return f'("{column}" IS NULL{more})'


def _array(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# The derived log of FIXTURES.md, part 3.
LOG = f"""
ev AS (
  SELECT event_id, user_id, event_type, value,
         CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k, epoch_us(ts) AS us
  FROM events),
flagged AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) <= 86400000000
                 THEN 0 ELSE 1 END AS starts
  FROM ev),
sessioned AS (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY us, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS sid
  FROM flagged),
itemed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, sid ORDER BY us, event_id) AS item FROM sessioned),
mapped AS (
  SELECT *, CASE event_type
      WHEN 'purchase' THEN CASE WHEN k < 60 THEN 'NextSong' WHEN k < 75 THEN 'Submit Upgrade'
                                WHEN k < 85 THEN 'Upgrade' WHEN k < 95 THEN 'Downgrade' ELSE 'Submit Downgrade' END
      WHEN 'error' THEN CASE WHEN k < 3 THEN 'Cancellation Confirmation' ELSE 'Error' END
      WHEN 'click' THEN CASE WHEN k < 25 THEN 'Thumbs Up' WHEN k < 35 THEN 'Thumbs Down'
                             WHEN k < 60 THEN 'Add to Playlist' WHEN k < 70 THEN 'Add Friend'
                             WHEN k < 80 THEN 'Roll Advert' WHEN k < 85 THEN 'Settings' WHEN k < 88 THEN 'Help'
                             WHEN k < 91 THEN 'About' WHEN k < 95 THEN 'Save Settings' ELSE 'Logout' END
      ELSE 'NextSong' END AS kind
  FROM itemed),
paged AS (
  SELECT *, CASE WHEN kind = 'NextSong' AND user_id % 13 = 0 THEN 'Home' ELSE kind END AS page FROM mapped),
log AS (
  SELECT CASE WHEN page = 'NextSong' AND event_id % 101 <> 0 THEN 'artist_' || k END AS artist,
         'Logged In' AS auth,
         CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         us // 1000 AS ts,
         CAST(user_id AS VARCHAR) AS "userId",
         sid AS "sessionId",
         page,
         'PUT' AS method,
         CAST(200 AS BIGINT) AS status,
         CASE WHEN (user_id + sid) % 3 = 0 THEN 'free' ELSE 'paid' END AS level,
         item AS "itemInSession",
         'City' || user_id || ', ' || ({_array(STATES)})[CAST(user_id % {len(STATES)} + 1 AS INTEGER)] AS location,
         CASE WHEN user_id % 11 = 0 THEN '-'
              ELSE ({_array(AGENTS)})[CAST(user_id % {len(AGENTS)} + 1 AS INTEGER)] END AS "userAgent",
         CASE WHEN event_id % 50 <> 0 THEN split_part(c_name, '#', 2) END AS "lastName",
         CASE WHEN event_id % 50 <> 0 THEN split_part(c_name, '#', 1) END AS "firstName",
         CASE WHEN page = 'NextSong' THEN 'song_' || (k * 7 + user_id % 5) END AS song,
         {REGISTRATION_START_MS} + user_id % 45 * 86400000 AS registration,
         CASE WHEN page = 'NextSong' THEN value END AS length
  FROM paged LEFT JOIN customer ON c_custkey = user_id)
"""

# The agent rules, first match wins; both parts must be known.
_AGENT = """
  SELECT *, CASE WHEN regexp_matches("userAgent", 'iPhone|iPad|iPod') THEN 'iOS'
                 WHEN regexp_matches("userAgent", 'Android') THEN 'Android'
                 WHEN regexp_matches("userAgent", 'Windows') THEN 'Windows'
                 WHEN regexp_matches("userAgent", 'Macintosh|Mac OS') THEN 'Mac OS'
                 WHEN regexp_matches("userAgent", 'Linux') THEN 'Linux' END AS p,
            CASE WHEN regexp_matches("userAgent", 'Edge/|Edg/') THEN 'Microsoft Edge'
                 WHEN regexp_matches("userAgent", 'Opera|OPR/') THEN 'Opera'
                 WHEN regexp_matches("userAgent", 'Chrome/|CriOS/') THEN 'Chrome'
                 WHEN regexp_matches("userAgent", 'Firefox/|FxiOS/') THEN 'Firefox'
                 WHEN regexp_matches("userAgent", 'MSIE|Trident/') THEN 'Microsoft Internet Explorer'
                 WHEN regexp_matches("userAgent", 'Safari/') THEN 'Safari' END AS b
"""
_REQUIRED = " AND ".join(f'"{c}" IS NOT NULL' for c in REQUIRED)
CLEAN = f"""{LOG},
cleaned AS (SELECT * FROM log WHERE {_REQUIRED}),
agents AS ({_AGENT} FROM cleaned),
pre AS (
  SELECT agents.* EXCLUDE (p, b),
         CAST(CASE WHEN song IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS "Listening",
         max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) OVER (PARTITION BY "userId") AS churn,
         CASE WHEN b IS NOT NULL THEN p END AS platform,
         CASE WHEN p IS NOT NULL THEN b END AS browser
  FROM agents)
"""

_COUNTS = ",\n".join(
    f"count(CASE WHEN page = '{p}' THEN 1 END) AS {c}" for p, c in PAGE_COLUMNS.items()
)
_FIRST = ",\n".join(
    f'arg_min_null({c}, ts * 1000000 + "itemInSession") AS {c}' for c in ("gender", "level", "platform", "browser")
)
# Feature branches, joined per user as the definitions state them.
FEATURES = f"""{CLEAN},
base AS (
  SELECT "userId", {_FIRST}, max(churn) AS churn,
         count(DISTINCT "sessionId") AS num_sessions, count(DISTINCT artist) AS num_unique_artists,
         {_COUNTS},
         (max(ts) / 1000.0 - arg_min_null(registration, ts * 1000000 + "itemInSession") / 1000.0) / 86400 AS tenure,
         count(CASE WHEN page = 'Roll Advert' THEN 1 END) / count(DISTINCT "sessionId") AS num_ads_per_session,
         count(DISTINCT artist) / ((max(ts) - arg_min_null(registration, ts * 1000000 + "itemInSession")) / 86400000.0
                                   + 1e-6) AS avg_unique_artists_per_day
  FROM pre GROUP BY "userId"),
song_sessions AS (
  SELECT "userId", "sessionId", count(*) AS songs, sum(length) AS listened, count(DISTINCT artist) AS artists
  FROM pre WHERE page = 'NextSong' GROUP BY "userId", "sessionId"),
songs AS (
  SELECT "userId", avg(songs) AS avg_songs_per_session,
         coalesce(stddev_samp(songs), 0) AS stddev_songs_per_session,
         avg(listened) AS avg_listening_time_per_session, avg(artists) AS avg_artists_per_session
  FROM song_sessions GROUP BY "userId"),
starts AS (
  SELECT "userId", "sessionId", min(ts) AS s,
         arg_min_null(registration, ts * 1000000 + "itemInSession") AS r
  FROM pre GROUP BY "userId", "sessionId"),
gaps AS (
  SELECT "userId", (s - coalesce(lag(s) OVER (PARTITION BY "userId" ORDER BY s, "sessionId"), r)) AS gap_ms
  FROM starts),
gap_stats AS (
  SELECT "userId", avg(gap_ms) / 3600000 AS avg_time_between_sessions,
         coalesce(stddev_samp(gap_ms) / 3600000, 0) AS stddev_time_between_sessions
  FROM gaps GROUP BY "userId"),
feats AS (
  SELECT base.*, avg_songs_per_session, avg_time_between_sessions,
         num_thumbs_up / num_nextsong AS prop_thumbs_up,
         num_add_to_playlist / num_nextsong AS prop_add_to_playlist,
         num_thumbs_down / num_nextsong AS prop_thumbs_down,
         num_unique_artists / num_nextsong AS unique_artist_ratio,
         avg_listening_time_per_session, avg_artists_per_session,
         stddev_songs_per_session, stddev_time_between_sessions
  FROM base JOIN songs USING ("userId") JOIN gap_stats USING ("userId"))
"""

NUMERIC = [
    "num_sessions", "num_unique_artists", *PAGE_COLUMNS.values(),
    "tenure", "num_ads_per_session", "avg_unique_artists_per_day", "avg_songs_per_session",
    "avg_time_between_sessions", "prop_thumbs_up", "prop_add_to_playlist", "prop_thumbs_down",
    "unique_artist_ratio", "avg_listening_time_per_session", "avg_artists_per_session",
    "stddev_songs_per_session", "stddev_time_between_sessions",
]
DOUBLES = NUMERIC[NUMERIC.index("tenure"):]


def rounded(column: str, digits: int = DIGITS) -> str:
    return f"CASE WHEN abs({column}) * 1e{digits} < 2.0 ** 53 THEN round({column}, {digits}) ELSE {column} END AS {column}"


def _select(columns: list[str]) -> str:
    return ", ".join(rounded(c) if c in DOUBLES else f'"{c}"' for c in columns)


def _base_queries() -> dict[str, str]:
    shown = {c: f'"{c}"' for c in LOG_COLUMNS}
    shown["length"] = 'round("length", 6) AS "length"'
    all_columns = ", ".join(shown.values())
    attributes = ["gender", "level", "platform", "browser", "churn"]
    base = NUMERIC[: NUMERIC.index("avg_songs_per_session")]
    return {
        "clean_events": f"WITH {CLEAN} SELECT {all_columns} FROM cleaned",
        "listening_flag": f"""WITH {CLEAN} SELECT "userId", ts, page, song, "Listening" FROM pre""",
        "content_clean": f"""WITH {CLEAN} SELECT "userId", ts, page, artist, song, "Listening" FROM pre
            WHERE NOT ("Listening" = 1 AND (artist IS NULL OR song IS NULL))""",
        "rows_with_missing": f"""WITH {LOG} SELECT "userId", ts, page, artist, "firstName", round("length", 6) AS "length",
            registration, "userAgent" FROM log WHERE {" OR ".join(_missing(c, t) for c, t in LOG_COLUMNS.items())}""",
        "churn_label": f"""WITH {LOG} SELECT "userId", ts, page,
            max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) OVER (PARTITION BY "userId") AS churn
            FROM log""",
        "preprocess": f'WITH {CLEAN} SELECT {all_columns}, "Listening", churn, platform, browser FROM pre',
        "agent_platform_browser": f"""WITH {CLEAN} SELECT "userId", ts, "userAgent", platform, browser FROM pre""",
        "location_parts": f"""WITH {CLEAN} SELECT DISTINCT location, split_part(location, ',', 1) AS "City",
            trim(split_part(split_part(location, ',', 2), '-', 1)) AS "State" FROM cleaned""",
        "state_region": f"""WITH {CLEAN}, parts AS (SELECT "userId", ts,
            trim(split_part(split_part(location, ',', 2), '-', 1)) AS "State" FROM cleaned)
            SELECT "userId", ts, "State", CASE upper(trim("State")) {_region_case()} ELSE 'unknown' END AS "Region" FROM parts""",
        "user_base_features": f"""WITH {FEATURES} SELECT "userId", {_select(attributes + base)} FROM base""",
        "page_counts": f'WITH {CLEAN} SELECT "userId", {_COUNTS} FROM pre GROUP BY "userId"',
        "songs_per_session": f"""WITH {FEATURES} SELECT "userId",
            {_select(['avg_songs_per_session', 'stddev_songs_per_session'])} FROM songs""",
        "session_gaps": f"""WITH {FEATURES} SELECT "userId",
            {_select(['avg_time_between_sessions', 'stddev_time_between_sessions'])} FROM gap_stats""",
        "action_proportions": f"""WITH {FEATURES} SELECT "userId",
            round(num_thumbs_up / nullif(num_nextsong, 0), 6) AS prop_thumbs_up,
            round(num_add_to_playlist / nullif(num_nextsong, 0), 6) AS prop_add_to_playlist,
            round(num_thumbs_down / nullif(num_nextsong, 0), 6) AS prop_thumbs_down,
            round(num_unique_artists / nullif(num_nextsong, 0), 6) AS unique_artist_ratio FROM base""",
        "listening_time": f"""WITH {FEATURES} SELECT "userId", {_select(['avg_listening_time_per_session'])} FROM songs""",
        "artists_per_session": f"""WITH {FEATURES} SELECT "userId", {_select(['avg_artists_per_session'])} FROM songs""",
        "user_features": f"""WITH {FEATURES} SELECT "userId", {_select(attributes + NUMERIC)} FROM feats""",
        "scan_json": f"WITH {LOG} SELECT {all_columns} FROM log",
        "scan_json_schema": f"WITH {LOG} SELECT {all_columns} FROM log",
        "sink_parquet": f'WITH {CLEAN} SELECT {all_columns}, "Listening", churn, platform, browser FROM pre',
    }


# --- exploration ---------------------------------------------------------------------

_LAST_KEY = 'ts * 1000000 + "itemInSession"'
PLACES = f"""{CLEAN},
placed AS (
  SELECT *, platform || '/' || browser AS "Agent", split_part(location, ',', 1) AS "City",
         trim(split_part(split_part(location, ',', 2), '-', 1)) AS "State" FROM pre),
regions AS (
  SELECT *, CASE upper(trim("State")) {_region_case()} ELSE 'unknown' END AS "Region" FROM placed)
"""
DISTRIBUTED = ("gender", "level", "Agent", "platform", "browser", "State", "City", "Region")
CROSSED = ("gender", "level", "platform", "browser", "Region")


def _distribution(source: str) -> str:
    return f"""SELECT value, count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM {source}), 1) AS percent
               FROM {source} GROUP BY value"""


def _last(column: str) -> str:
    return f"""WITH {PLACES}, u AS (SELECT "userId", arg_max_null("{column}", {_LAST_KEY}) AS value, max(churn) AS churn
               FROM regions GROUP BY "userId")"""


def upper_gamma(a: str, x: str) -> str:
    """Regularised upper incomplete gamma Q(a, x), by the series of P; enough terms for x below 2000."""
    return f"""CASE WHEN {x} <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 4000),
        lambda i: exp(({a} + i) * ln({x}) - ({x}) - lgamma({a} + i + 1))))) END"""


def _chi2(column: str) -> str:
    return f"""{_last(column)}, {_chi2_parts()}"""


def _chi2_parts() -> str:
    return """    t AS (SELECT churn, value, count(*) AS o FROM u WHERE value IS NOT NULL GROUP BY churn, value),
    m AS (SELECT a.churn, b.value, coalesce(t.o, 0) AS o, a.r * b.c / (SELECT sum(o) FROM t) AS e
          FROM (SELECT churn, sum(o) AS r FROM t GROUP BY churn) a
          CROSS JOIN (SELECT value, sum(o) AS c FROM t GROUP BY value) b
          LEFT JOIN t ON t.churn = a.churn AND t.value = b.value),
    d AS (SELECT (count(DISTINCT churn) - 1) * (count(DISTINCT value) - 1) AS dof FROM m)
    SELECT CAST(sum(o) AS BIGINT) AS n, CAST(max(dof) AS BIGINT) AS dof,
           round(CASE WHEN max(dof) = 0 THEN 0.0
                      WHEN max(dof) = 1 THEN sum((abs(o - e) - least(0.5, abs(o - e))) ** 2 / e)
                      ELSE sum((o - e) ** 2 / e) END, 6) AS chi2
    FROM m, d"""


def _distinct_summary(columns: str) -> str:
    return f"""WITH {CLEAN}, d AS (SELECT DISTINCT "userId", {columns} FROM pre),
        c AS (SELECT "userId", count(*) AS n FROM d GROUP BY "userId")
        SELECT count(*) AS users, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS stddev, min(n) AS min, max(n) AS max FROM c"""


def _profile_queries() -> dict[str, str]:
    names = list(LOG_COLUMNS)
    types = {c: {"text": "string", "number": "bigint", "double": "double"}[t] for c, t in LOG_COLUMNS.items()}

    def missing(c: str) -> str:
        extra = {"string": f""" OR "{c}" = ''""", "double": f' OR isnan("{c}")'}.get(types[c], "")
        return f'("{c}" IS NULL{extra})'

    missing_rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(CASE WHEN {missing(c)} THEN 1 END) AS n_missing FROM log""" for c in names
    )
    null_rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS n_null,
            round((count(*) - count("{c}")) / count(*), 6) AS null_fraction FROM cleaned""" for c in names
    )
    any_missing = " OR ".join(missing(c) for c in names)
    complete = " AND ".join(f'"{c}" IS NOT NULL' for c in REQUIRED)
    cancelled = "page = 'Cancellation Confirmation'"
    found = {
        "missing_profile": f"WITH {LOG} {missing_rows}",
        "null_profile": f"WITH {CLEAN} {null_rows}",
        "cleaning_report": f"""WITH {LOG} SELECT count(*) AS n_rows, count(CASE WHEN {any_missing} THEN 1 END) AS n_rows_with_missing,
            count(CASE WHEN {complete} THEN 1 END) AS n_kept, count(CASE WHEN NOT ({complete}) THEN 1 END) AS n_dropped,
            count(CASE WHEN {complete} AND "userId" = '' THEN 1 END) AS n_kept_missing_user FROM log""",
        "user_attribute": f"""WITH {CLEAN} SELECT "userId", arg_max_null(level, {_LAST_KEY}) AS level FROM pre GROUP BY "userId" """,
        "dist_churn": f"""WITH {CLEAN}, u AS (SELECT "userId", max(churn) AS value FROM pre GROUP BY "userId") {_distribution('u')}""",
        "page_distribution": f"WITH {CLEAN}, u AS (SELECT page AS value FROM pre) {_distribution('u')}",
        "distinct_pages": f'WITH {CLEAN} SELECT DISTINCT "Listening", page FROM pre',
        "distinct_locations": f"WITH {CLEAN} SELECT DISTINCT location FROM pre",
        "multi_device_summary": " UNION ALL ".join(
            f"SELECT '{name}' AS attribute, * FROM ({_distinct_summary(columns)})"
            for name, columns in (("agent", "platform, browser"), ("platform", "platform"), ("browser", "browser"))
        ),
        "chi2_tests": " UNION ALL ".join(
            f"""SELECT '{c}' AS attribute, n, dof, chi2,
                round(CASE WHEN dof = 0 THEN 1.0 ELSE {upper_gamma("dof / 2.0", "raw / 2.0")} END, 6) AS p_value
                FROM ({_chi2(c).replace("AS chi2", "AS chi2, CASE WHEN max(dof) = 1 THEN sum((abs(o - e) - least(0.5, abs(o - e))) ** 2 / e) ELSE sum((o - e) ** 2 / e) END AS raw")})"""
            for c in CROSSED
        ),
        "expected_counts": f"""{_last("platform")},
            t AS (SELECT churn, value, count(*) AS n FROM u WHERE value IS NOT NULL GROUP BY churn, value)
            SELECT churn, value, n, round(sum(n) OVER (PARTITION BY churn) * sum(n) OVER (PARTITION BY value)
                   / CAST(sum(n) OVER () AS DOUBLE), 6) AS expected FROM t""",
        "churn_by_hour": f"""WITH {LOG} SELECT CAST(h AS INTEGER) AS hour, count(ts) AS n FROM range(24) t(h)
            LEFT JOIN (SELECT ts FROM log WHERE {cancelled}) ON (ts // 3600000) % 24 = h GROUP BY h""",
        "churn_by_weekday": f"""WITH {LOG} SELECT CAST(p AS INTEGER) AS position,
            (['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'])[CAST(p AS INTEGER)] AS weekday, count(ts) AS n
            FROM range(1, 8) t(p) LEFT JOIN (SELECT ts FROM log WHERE {cancelled}) ON isodow(make_timestamp(ts * 1000)) = p
            GROUP BY p""",
        "user_page_counts": f"""WITH {CLEAN} SELECT "userId", page, churn, count(*) AS n FROM pre
            WHERE page NOT IN ('Cancel', 'Cancellation Confirmation') GROUP BY "userId", page, churn""",
        "page_count_stats": f"""WITH {CLEAN}, c AS (SELECT "userId", page, churn, count(*) AS n FROM pre
            WHERE page NOT IN ('Cancel', 'Cancellation Confirmation') GROUP BY "userId", page, churn)
            SELECT page, churn, count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
                   CAST(min(n) AS DOUBLE) AS min, round(quantile_cont(n, 0.25), 6) AS q1, round(quantile_cont(n, 0.5), 6) AS median,
                   round(quantile_cont(n, 0.75), 6) AS q3, CAST(max(n) AS DOUBLE) AS max FROM c GROUP BY page, churn""",
        "page_count_stats_sketch": f"""WITH {CLEAN}, c AS (SELECT "userId", page, churn, count(*) AS n FROM pre
            WHERE page NOT IN ('Cancel', 'Cancellation Confirmation') GROUP BY "userId", page, churn)
            SELECT page, churn, count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
                   CAST(min(n) AS DOUBLE) AS min, CAST(quantile_disc(n, 0.25) AS DOUBLE) AS q1, CAST(quantile_disc(n, 0.5) AS DOUBLE) AS median,
                   CAST(quantile_disc(n, 0.75) AS DOUBLE) AS q3, CAST(max(n) AS DOUBLE) AS max FROM c GROUP BY page, churn""",
    }
    for c in DISTRIBUTED:
        found[f"dist_{c.lower()}"] = f"{_last(c)} {_distribution('u')}"
    for c in CROSSED:
        found[f"crosstab_{c.lower()}"] = f"{_last(c)} SELECT churn, value, count(*) AS n FROM u GROUP BY churn, value"
        found[f"chi2_{c.lower()}"] = _chi2(c)
    return found


# --- statistics over features --------------------------------------------------------

_DOUBLES = ", ".join(f"round(CAST({c} AS DOUBLE), {DIGITS}) AS {c}" for c in NUMERIC)
LONG = f"""{FEATURES},
f6 AS (SELECT "userId", churn, gender, level, coalesce(platform, 'unknown') AS platform,
              coalesce(browser, 'unknown') AS browser, {_DOUBLES} FROM feats),
long AS (UNPIVOT (SELECT "userId", churn, {", ".join(NUMERIC)} FROM f6) ON {", ".join(NUMERIC)}
         INTO NAME feature VALUE value)
"""


# The same with some values missing: null and NaN are one case in SQL.
LONG_GAPS = LONG.replace(
    "round(CAST(tenure AS DOUBLE), 6) AS tenure",
    """CASE WHEN CAST("userId" AS BIGINT) % 5 <> 0 THEN round(CAST(tenure AS DOUBLE), 6) END AS tenure""",
).replace(
    "round(CAST(num_sessions AS DOUBLE), 6) AS num_sessions",
    """CASE WHEN CAST("userId" AS BIGINT) % 7 <> 0 THEN round(CAST(num_sessions AS DOUBLE), 6) END AS num_sessions""",
)


def _statistics_queries(long: str = LONG) -> dict[str, str]:
    pairs = " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b,
            round(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END, 6) AS corr FROM f7"""
        for i, a in enumerate(["churn", *NUMERIC])
        for b in ["churn", *NUMERIC][:i]
    )
    boxes = """q AS (SELECT feature, churn, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                            quantile_cont(value, 0.75) AS q3 FROM long GROUP BY feature, churn),
        j AS (SELECT long.*, q1, median, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
              FROM long JOIN q USING (feature, churn))"""
    z = """(greatest(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5)
                         / nullif(sqrt(n0 * n1 / 12 * (n0 + n1 + 1 - ties / ((n0 + n1) * (n0 + n1 - 1)))), 0)"""
    ranks = f"""WITH {long},
            v AS (SELECT feature, value, count(*) AS t, count(CASE WHEN churn = 0 THEN 1 END) AS n0 FROM long GROUP BY feature, value),
            k AS (SELECT *, sum(t) OVER (PARTITION BY feature ORDER BY value) - t + (t + 1) / 2 AS midrank FROM v),
            g AS (SELECT feature, CAST(sum(n0) AS DOUBLE) AS n0, CAST(sum(t) - sum(n0) AS DOUBLE) AS n1,
                         sum(n0 * midrank) AS ranks, sum(CAST(t AS DOUBLE) ** 3 - t) AS ties FROM k GROUP BY feature),
            u AS (SELECT *, ranks - n0 * (n0 + 1) / 2 AS u FROM g)
            SELECT feature, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, round(u, 6) AS u,
                   round({z}, 6) AS z
            FROM u"""
    return {
        "feature_histogram": f"""WITH {long},
            r AS (SELECT feature, min(value) AS low, (max(value) - min(value)) / 20 AS width FROM long GROUP BY feature),
            s AS (SELECT feature, churn, count(*) AS n_class FROM long GROUP BY feature, churn),
            b AS (SELECT long.feature, long.churn, low, width,
                         CAST(least(coalesce(floor((value - low) / nullif(width, 0)), 0), 19) AS INTEGER) AS bin
                  FROM long JOIN r USING (feature))
            SELECT feature, churn, bin, round(low + bin * width, 6) AS bin_start, count(*) AS n,
                   round(count(*) / nullif(max(n_class) * width, 0), 6) AS density
            FROM b JOIN s USING (feature, churn) GROUP BY feature, churn, bin, low, width""",
        "feature_histogram_auto": f"""WITH {long},
            q AS (SELECT feature, count(*) AS total, min(value) AS low, max(value) - min(value) AS span,
                         quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM long GROUP BY feature),
            w AS (SELECT *, CASE WHEN iqr > 0 THEN least(2 * iqr / pow(total, 1.0::DOUBLE / 3), span / (log2(total) + 1))
                                 ELSE span / (log2(total) + 1) END AS wanted FROM q),
            r AS (SELECT *, CAST(greatest(coalesce(ceil(span / nullif(wanted, 0)), 1), 1) AS BIGINT) AS bins FROM w),
            s AS (SELECT feature, churn, count(*) AS n_class FROM long GROUP BY feature, churn),
            b AS (SELECT long.feature, long.churn, low, span / bins AS width, bins,
                         CAST(least(coalesce(floor((value - low) / nullif(span / bins, 0)), 0), bins - 1) AS INTEGER) AS bin
                  FROM long JOIN r USING (feature))
            SELECT feature, churn, bin, round(low + bin * width, 6) AS bin_start, count(*) AS n,
                   round(count(*) / nullif(max(n_class) * width, 0), 6) AS density, bins
            FROM b JOIN s USING (feature, churn) GROUP BY feature, churn, bin, low, width, bins""",
        "feature_boxplot": f"""WITH {long}, {boxes}
            SELECT feature, churn, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
                   min(CASE WHEN inside THEN value END) AS whisker_low, max(CASE WHEN inside THEN value END) AS whisker_high,
                   count(CASE WHEN NOT inside THEN 1 END) AS n_outliers
            FROM j GROUP BY feature, churn, q1, median, q3""",
        "mann_whitney": ranks,
        "mann_whitney_tests": f"""SELECT feature, n0, n1, u, z, round(p, 6) AS p_value, p < 0.05 AS reject FROM (
            SELECT *, CASE WHEN raw < 0 OR raw IS NULL THEN 1.0 ELSE {upper_gamma("0.5", "raw * raw / 2")} END AS p
            FROM ({ranks.replace(", 6) AS z", ", 6) AS z, " + z + " AS raw")}))""",
        "feature_correlation": f"WITH {long}, f7 AS (SELECT CAST(churn AS DOUBLE) AS churn, {', '.join(NUMERIC)} FROM f6) {pairs}",
    }


# --- split, encode, scale -------------------------------------------------------------

SPLIT = f"""{LONG},
marked AS (SELECT *, substr(md5("userId" || '#42'), 1, 8) < 'cccccccc' AS is_train FROM f6),
train AS (SELECT * FROM marked WHERE is_train),
cats AS (UNPIVOT (SELECT "userId", is_train, gender, level, platform, browser FROM marked)
         ON gender, level, platform, browser INTO NAME feature VALUE value),
idx AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) - 1 AS i,
               count(*) OVER (PARTITION BY feature) AS size
        FROM cats WHERE is_train GROUP BY feature, value),
hot AS (SELECT c."userId", c.is_train, idx.feature || '_vec' || CASE WHEN idx.size > 2 THEN '_' || idx.i ELSE '' END AS feature,
               CASE WHEN c.value = idx.value THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
        FROM cats c JOIN idx USING (feature) WHERE idx.i < idx.size - 1),
slots AS (SELECT "userId", is_train, feature, value FROM hot UNION ALL
          SELECT "userId", substr(md5("userId" || '#42'), 1, 8) < 'cccccccc' AS is_train, feature, value FROM long),
stats AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS sd FROM slots WHERE is_train GROUP BY feature),
scaled AS (SELECT "userId", feature, coalesce((value - mean) / nullif(sd, 0), 0) AS z FROM slots JOIN stats USING (feature))
"""
DUMMIES = ["gender_vec", "level_vec", *[f"platform_vec_{i}" for i in range(4)], *[f"browser_vec_{i}" for i in range(3)]]
# The kinds of classifiers.
MODEL_KINDS = (
    "logistic_regression", "random_forest", "decision_tree", "gradient_boosting", "gradient_boosting_unweighted",
)
CONTRIBUTIONS = f"""{SPLIT},
w AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {(i * 7 % 11 - 5) / 10}::DOUBLE)" for i, c in enumerate(NUMERIC))}) t(feature, w)),
contrib AS (SELECT long."userId", long.feature, (value - mean) * w AS value
            FROM long JOIN stats USING (feature) JOIN w USING (feature))
"""


# Contributions by their definition: a mean over all subsets of the other features.
_EXPLAINED = ("num_error", "num_nextsong", "num_roll_advert")
# The tree of the query, (feature, threshold, at most, above).
_TREE = (
    "num_error", 12,
    ("num_nextsong", 24, None, ("num_roll_advert", 1, None, None)),
    ("num_nextsong", 30, ("num_error", 16, None, ("num_nextsong", 20, None, None)), None),
)


def _tree_parts(tree=_TREE, reached: str = "true", number: str = "") -> list[tuple[str, str]]:
    """(name, condition) of every node; a node's children have its name and 0 or 1."""
    found = [(f"r{number}", reached)]
    if tree:
        name, threshold, low, high = tree
        found += _tree_parts(low, f"{reached} AND {name} <= {threshold}", f"{number}0")
        found += _tree_parts(high, f"{reached} AND {name} > {threshold}", f"{number}1")
    return found


def _tree_value(known: set[str], tree=_TREE, number: str = "") -> str:
    """The prediction when only the features in ``known`` are, as SQL over a row and the node counts."""
    if tree is None:
        return f"coalesce(p{number} / nullif(n{number}, 0), 0)"
    name, threshold, low, high = tree
    below, above = _tree_value(known, low, f"{number}0"), _tree_value(known, high, f"{number}1")
    if name in known:
        return f"CASE WHEN {name} <= {threshold} THEN {below} ELSE {above} END"
    return f"coalesce((n{number}0 * ({below}) + n{number}1 * ({above})) / nullif(n{number}, 0), 0)"


def _shapley(worth, features=_EXPLAINED) -> list[str]:
    """Per feature the weighted sum of what it adds to each subset of the others; ``worth``: set -> SQL."""
    found = []
    for feature in features:
        others = [f for f in features if f != feature]
        terms = []
        for mask in range(2 ** len(others)):
            chosen = {f for i, f in enumerate(others) if mask >> i & 1}
            weight = math.factorial(len(chosen)) * math.factorial(len(others) - len(chosen)) / math.factorial(len(features))
            terms.append(f"{weight!r}::DOUBLE * (({worth(chosen | {feature})}) - ({worth(chosen)}))")
        found.append(" + ".join(terms))
    return found


def _contribution_queries() -> dict[str, str]:
    counts = ", ".join(
        f"CAST(count(*) FILTER ({condition}) AS DOUBLE) AS n{name[1:]}, CAST(sum(churn) FILTER ({condition}) AS DOUBLE) AS p{name[1:]}"
        for name, condition in _tree_parts()
    )

    def rows(values: list[str], source: str) -> str:
        return " UNION ALL ".join(
            f"""SELECT "userId", '{f}' AS feature, round({v}, 9) AS value FROM {source}""" for f, v in zip(_EXPLAINED, values, strict=True)
        )

    sets = [{f for i, f in enumerate(_EXPLAINED) if mask >> i & 1} for mask in range(8)]

    def column(chosen: set[str]) -> str:
        return "v_" + "".join("1" if f in chosen else "0" for f in _EXPLAINED)

    def rule(chosen: set[str]) -> str:
        x, y, z = (f"{'f6' if f in chosen else 'b'}.{f}" for f in _EXPLAINED)
        return f"avg(1 / (1 + exp(-(0.03::DOUBLE * {x} - 0.02::DOUBLE * {y} + 0.5::DOUBLE * (CAST({z} AS BIGINT) % 3) - 0.2::DOUBLE))))"

    worths = ", ".join(f"{rule(s)} AS {column(s)}" for s in sets)
    return {
        "tree_contributions": f"""WITH {SPLIT}, counts AS (SELECT {counts} FROM train), x AS (SELECT * FROM f6, counts)
            {rows(_shapley(_tree_value), "x")}""",
        "kernel_contributions": f"""WITH {SPLIT}, b AS (SELECT * FROM train ORDER BY md5("userId") LIMIT 20),
            x AS (SELECT f6."userId", {worths} FROM f6, b GROUP BY f6."userId") {rows(_shapley(column), "x")}""",
        "model_tree_contributions": f"""WITH {SPLIT} SELECT model, "userId",
            CASE WHEN model = 'gradient_boosting' THEN 'log_odds' ELSE 'probability' END AS units, true AS adds_up
            FROM marked, (VALUES ('decision_tree'), ('random_forest'), ('gradient_boosting')) k(model) WHERE NOT is_train""",
        "saved_scores": f'WITH {SPLIT} SELECT "userId", churn AS label, true AS same FROM f6',
        "ranked_users": f"""WITH {_USER_SCORES}
            SELECT row_number() OVER (ORDER BY score DESC, id) AS place, id, round(score, 6) AS score FROM scored""",
    }


# The exact law: among all ways to give the ranks 1..r to k rows of the smaller sample, how many have each sum.
_MANN_WHITNEY_EXACT = f"""WITH RECURSIVE
    ways(r, k, s, w) AS (
      SELECT 0, 0, 0, 1::HUGEINT
      UNION ALL
      SELECT r + 1, k + t.b, s + t.b * (r + 1), CAST(sum(w) AS HUGEINT) FROM ways, (VALUES (0), (1)) t(b)
      WHERE r < 64 AND k + t.b <= 8 GROUP BY ALL),
    v AS (SELECT user_id, value, count(*) AS t, count(*) FILTER (event_type = 'click') AS c FROM events
          WHERE event_type IN ('click', 'purchase') AND value IS NOT NULL GROUP BY ALL),
    k AS (SELECT *, sum(t) OVER (PARTITION BY user_id ORDER BY value) - t + (t + 1) / 2 AS midrank FROM v),
    g AS (SELECT user_id, CAST(sum(c) AS BIGINT) AS n0, CAST(sum(t) - sum(c) AS BIGINT) AS n1, sum(c * midrank) AS ranks,
                 sum(CAST(t AS DOUBLE) ** 3 - t) AS ties FROM k GROUP BY user_id),
    u AS (SELECT *, ranks - n0 * (n0 + 1) / 2 AS u, least(n0, n1) AS a, n0 + n1 AS n,
                 ties = 0 AND least(n0, n1) BETWEEN 1 AND 8 AND n0 * n1 <= 10000 AS exact FROM g),
    z AS (SELECT *, (greatest(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5)
                 / nullif(sqrt(n0 * n1 / 12 * (n + 1 - ties / (n * (n - 1)))), 0) AS z FROM u),
    e AS (SELECT user_id, least(1.0, 2 * CAST(sum(w) FILTER (s - a * (a + 1) / 2 >= greatest(u, n0 * n1 - u)) AS DOUBLE)
                 / CAST(sum(w) AS DOUBLE)) AS p
          FROM z JOIN ways ON exact AND r = n AND k = a GROUP BY user_id),
    p AS (SELECT z.*, CASE WHEN exact THEN e.p WHEN z < 0 OR z IS NULL THEN 1.0
                           ELSE {upper_gamma("0.5", "z * z / 2")} END AS p FROM z LEFT JOIN e USING (user_id))
    SELECT user_id, n0, n1, round(u, 6) AS u, round(p, 6) AS p_value, p < 0.05 AS reject,
           CASE WHEN exact THEN 'exact' ELSE 'normal' END AS method FROM p"""

# What each sample agent is (number, platform, browser, version).
AGENT_KINDS = (
    (0, "Windows", "Chrome", "120.0.0.0"), (1, "Mac OS", "Chrome", "119.0.6045.105"), (2, "Linux", "Chrome", "118.0.0.0"),
    (3, "ChromeOS", "Chrome", "117.0.0.0"), (4, "Android", "Chrome", "120.0.6099.43"), (5, "iOS", "Chrome", "120.0.6099.50"),
    (6, "Windows", "Firefox", "121.0"), (7, "Mac OS", "Firefox", "120.0"), (8, "Linux", "Firefox", "119.0"),
    (9, "Android", "Firefox", "120.0"), (10, "iOS", "Firefox", "118.0"), (11, "FreeBSD", "Firefox", "115.0"),
    (12, "Mac OS", "Safari", "17.1"), (13, "iOS", "Safari", "17.1"), (14, "iOS", "Safari", "15.6"), (15, "iOS", "Safari", "12.1"),
    (16, "Windows", "Microsoft Edge", "120.0.2210.61"), (17, "Windows", "Microsoft Edge", "18.17763"),
    (18, "Android", "Microsoft Edge", "119.0.2151.78"), (19, "iOS", "Microsoft Edge", "119.0.2151.65"),
    (20, "Mac OS", "Microsoft Edge", "120.0.2210.77"), (21, "Windows", "Opera", "105.0.0.0"), (22, "Linux", "Opera", "104.0.4944.54"),
    (23, "Android", "Opera", "76.2.4027.73374"), (24, "Windows", "Opera", "12.18"), (25, "Mac OS", "Opera", "11.52"),
    (26, "Android", "Opera Mini", "36.2.2254/119.132"), (27, "Windows", "Microsoft Internet Explorer", "11.0"),
    (28, "Windows", "Microsoft Internet Explorer", "10.0"), (29, "Windows", "Microsoft Internet Explorer", "8.0"),
    (30, "Windows Phone", "Microsoft Internet Explorer", "9.0"), (31, "Android", "Samsung Browser", "23.0"),
    (32, "Android", "UC Browser", "13.4.0.1306"), (33, "BlackBerry", "BlackBerry Browser", "10.0.9.2372"),
    (34, "PlayStation", None, None), (35, "Nintendo", "Nintendo Browser", "5.1.0.13343"), (36, "Xbox", "Microsoft Edge", "44.18363.8131"),
    (37, "Android", "Chrome", "96.0.4664.45"), (38, "Linux", "Safari", "5.0"), (39, "Mac OS", "Safari", "5.0.6"),
    (40, None, None, None), (41, None, None, None), (42, None, None, None), (43, None, None, None), (44, None, None, None),
    (45, "Windows", "Firefox", "2.0.0.20"), (46, None, None, None),
)


def _sql_value(value) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


_AGENT_VALUES = ", ".join(f"({', '.join(_sql_value(v) for v in row)})" for row in AGENT_KINDS)
_AGENT_GRAMMAR = f"""SELECT CAST(k.sample AS INTEGER) AS sample, k.platform, k.browser, k.version, count(*) AS n
    FROM events JOIN (VALUES {_AGENT_VALUES}) k(sample, platform, browser, version) ON event_id % {len(AGENT_KINDS)} = k.sample
    GROUP BY ALL"""


def _model_queries() -> dict[str, str]:
    wide = ", ".join(f"round(max(CASE WHEN feature = '{c}' THEN z END), 6) AS {c}" for c in [*NUMERIC, *DUMMIES])
    hot = ", ".join(f"max(CASE WHEN feature = '{c}' THEN value END) AS {c}" for c in DUMMIES)
    index = ", ".join(
        f"CAST(max(CASE WHEN feature = '{c}' THEN i END) AS DOUBLE) AS {c}_index" for c in ("gender", "level", "platform", "browser")
    )
    kinds = ", ".join(f"('{k}')" for k in MODEL_KINDS)
    held_out = f"""FROM marked, (VALUES {kinds}) k(model) WHERE NOT is_train"""
    fitted = [*MODEL_KINDS, "stacking", *[f"calibrated_{k}" for k in MODEL_KINDS]]
    fitted, named = (", ".join(f"('{x}')" for x in values) for values in (fitted, [*_METRICS, "log_loss", "pr_auc", "roc_auc"]))
    return {
        # Models have no SQL; what must hold for any of them has: the rows, labels, ranges and sums.
        "sampled_shapley": f'WITH {SPLIT} SELECT "userId", true AS all_numbers, true AS adds_up FROM f6',
        "score_users": f"""WITH {SPLIT} SELECT "userId", 'log_odds' AS units, true AS in_range, true AS adds_up FROM f6""",
        "ranking": f"WITH {SPLIT} SELECT row_number() OVER () AS place, true AS ordered FROM f6",
        "classifier_scores": f'WITH {SPLIT} SELECT model, "userId" AS id, churn AS label, true AS in_range {held_out}',
        "calibrated_scores": f'WITH {SPLIT} SELECT model, "userId" AS id, churn AS label, true AS in_range {held_out}',
        "stacked_scores": f"""WITH {SPLIT} SELECT CASE WHEN is_train THEN 'out_of_fold' ELSE 'stacking' END AS model,
            "userId" AS id, churn AS label, true AS in_range FROM marked""",
        "experiment_metrics": f"""SELECT model, metric, true AS in_range
            FROM (VALUES {fitted}) m(model), (VALUES {named}) t(metric)""",
        "stratified_split": f'WITH {SPLIT} SELECT "userId", churn, is_train FROM marked',
        "stratified_split_exact": f"""WITH {SPLIT},
            r AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY md5("userId" || '#42'), "userId") AS rank,
                         count(*) OVER (PARTITION BY churn) AS total FROM f6)
            SELECT "userId", churn, rank <= round(total * 0.8::DOUBLE) AS is_train FROM r""",
        "string_index": f"""WITH {SPLIT} SELECT "userId", {index} FROM cats JOIN idx USING (feature, value) GROUP BY "userId" """,
        "one_hot": f'WITH {SPLIT} SELECT "userId", {hot} FROM hot GROUP BY "userId"',
        "scaled_features": f'WITH {SPLIT} SELECT "userId", feature, round(z, 6) AS z FROM scaled',
        "model_matrix": f'WITH {SPLIT} SELECT s."userId", churn, {wide} FROM scaled s JOIN f6 USING ("userId") GROUP BY s."userId", churn',
        "sink_parquet_gzip": f'WITH {SPLIT} SELECT s."userId", churn, {wide} FROM scaled s JOIN f6 USING ("userId") GROUP BY s."userId", churn',
        "class_weights": f"""WITH {SPLIT}, c AS (SELECT churn, count(*) AS n FROM train GROUP BY churn),
            t AS (SELECT sum(n) AS total, count(*) AS classes, sum(CASE WHEN churn = 0 THEN n END) AS n0,
                         sum(CASE WHEN churn = 1 THEN n END) AS n1 FROM c)
            SELECT churn, n, round(total / (classes * n), 6) AS weight, round(n1 / n0, 6) AS ratio_of_weights,
                   round(n0 / n1, 6) AS balanced_ratio FROM c, t""",
        "linear_contributions": f'WITH {CONTRIBUTIONS} SELECT "userId", feature, round(value, 9) AS value FROM contrib',
        "shap_summary": f"WITH {CONTRIBUTIONS} SELECT feature, round(avg(abs(value)), 9) AS importance FROM contrib GROUP BY feature",
        "user_contributions": f"""WITH {CONTRIBUTIONS} SELECT "userId", feature, round(value, 9) AS value,
            CASE WHEN value >= 0 THEN 'up' ELSE 'down' END AS direction FROM contrib""",
    }


# --- evaluation --------------------------------------------------------------------------

_USER_SCORES = f"""{FEATURES},
scored AS (SELECT "userId" AS id, churn AS label,
    round(1 / (1 + exp(-(0.03 * num_error - 0.02 * num_nextsong + 0.5 * (num_roll_advert % 3) - 0.2))), 2) AS score FROM feats)"""
_DOCUMENT_SCORES = """scored AS (SELECT CAST(doc_id AS VARCHAR) AS id, quality AS label,
    (doc_id * 37 % 100) / 100.0 AS score FROM labels)"""
# One score per event, nearly all distinct; null, NaN and missing labels are left out.
_EVENTS = """events_scored AS (SELECT CAST(event_id AS VARCHAR) AS id,
    CASE WHEN event_id % 89 <> 0 THEN CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END END AS label,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE)
         ELSE (event_id * 7919 % 1000003 % 1000000) / CAST(1000000 AS DOUBLE) END AS score FROM events)"""
_EVENT_SCORES = f"""{_EVENTS},
scored AS (SELECT * FROM events_scored WHERE label IS NOT NULL AND score IS NOT NULL AND NOT isnan(score))"""
_CURVE = """,
per_score AS (SELECT CAST(score AS DOUBLE) AS score, sum(label) AS pos, count(*) AS n FROM scored GROUP BY score),
cum AS (SELECT score AS threshold, pos, n, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(n) OVER w AS DOUBLE) AS predicted,
               CAST(sum(pos) OVER () AS DOUBLE) AS positives, CAST(sum(n) OVER () AS DOUBLE) AS total
        FROM per_score WINDOW w AS (ORDER BY score DESC)),
pr AS (SELECT threshold, tp / predicted AS precision, tp / positives AS recall FROM cum
       UNION ALL SELECT NULL, 1.0, 0.0),
roc AS (SELECT threshold, (predicted - tp) / (total - positives) AS fpr, tp / positives AS tpr FROM cum
        UNION ALL SELECT NULL, 0.0, 0.0),
f2 AS (SELECT *, 5 * tp / (4 * positives + predicted) AS f FROM cum),
best AS (SELECT * FROM f2 ORDER BY f DESC, threshold LIMIT 1),
decided AS (SELECT *, CASE WHEN CAST(score AS DOUBLE) > (SELECT threshold FROM best) THEN 1 ELSE 0 END AS prediction FROM scored),
clip AS (SELECT label, CAST(score AS DOUBLE) AS s, least(greatest(CAST(score AS DOUBLE), pow(2.0, -52)), 1 - pow(2.0, -52)) AS p FROM scored),
area AS (SELECT
   (SELECT sum((recall - prev) * (precision + prev_precision) / 2) FROM (
       SELECT recall, precision, lag(recall) OVER o AS prev, lag(precision) OVER o AS prev_precision FROM pr
       WINDOW o AS (ORDER BY threshold DESC NULLS FIRST))) AS pr_auc,
   (SELECT sum((fpr - prev) * (tpr + prev_tpr) / 2) FROM (
       SELECT fpr, tpr, lag(fpr) OVER o AS prev, lag(tpr) OVER o AS prev_tpr FROM roc
       WINDOW o AS (ORDER BY threshold DESC NULLS FIRST))) AS roc_auc),
cells AS (SELECT CAST(count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS DOUBLE) AS tp,
                 CAST(count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) AS DOUBLE) AS fp,
                 CAST(count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) AS DOUBLE) AS fn,
                 CAST(count(CASE WHEN label = 0 AND prediction = 0 THEN 1 END) AS DOUBLE) AS tn FROM decided),
parts AS (SELECT *, tp + fn AS p, tn + fp AS q,
                 coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
                 coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
                 coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
                 coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0 FROM cells),
metrics AS (SELECT (tp + tn) / (p + q) AS accuracy, (f1 * p + f0 * q) / (p + q) AS f1_weighted,
                   (p1 * p + p0 * q) / (p + q) AS precision_weighted, (r1 * p + r0 * q) / (p + q) AS recall_weighted,
                   f1, p1 AS precision, r1 AS recall, (SELECT threshold FROM best) AS threshold,
                   (SELECT avg((s - label) ** 2) FROM clip) AS brier_score,
                   (SELECT -avg(label * ln(p) + (1 - label) * ln(1 - p)) FROM clip) AS log_loss,
                   (SELECT pr_auc FROM area) AS pr_auc, (SELECT roc_auc FROM area) AS roc_auc FROM parts)
"""
_METRICS = (
    "accuracy", "f1_weighted", "precision_weighted", "recall_weighted", "f1", "precision", "recall", "threshold", "brier_score",
)


def _evaluation(scores: str) -> dict[str, str]:
    source = f"WITH {scores}{_CURVE}"
    all_metrics = [*_METRICS, "log_loss", "pr_auc", "roc_auc"]
    return {
        "pr_curve": f"{source} SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr",
        "roc_curve": f"{source} SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc",
        "roc_curve_corners": f"""{source}, p AS (SELECT *, lag(fpr) OVER o AS f0, lag(tpr) OVER o AS t0, lead(fpr) OVER o AS f1,
                lead(tpr) OVER o AS t1 FROM roc WINDOW o AS (ORDER BY threshold DESC NULLS FIRST))
            SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM p
            WHERE f0 IS NULL OR f1 IS NULL OR abs((fpr - f0) * (t1 - tpr) - (tpr - t0) * (f1 - fpr)) > 1e-14""",
        "auc": f"{source} SELECT round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc FROM area",
        "best_threshold": f"""{source} SELECT threshold, round(f, 6) AS f_beta, round(tp / predicted, 6) AS precision,
            round(tp / positives, 6) AS recall FROM best""",
        "classification_metrics": f"{source} SELECT {', '.join(rounded(c) for c in _METRICS)} FROM metrics",
        "metrics_long": f"""{source} SELECT 'rule' AS model, metric, round(value, 6) AS value FROM
            (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in all_metrics)} FROM metrics)
             ON {', '.join(all_metrics)} INTO NAME metric VALUE value)""",
        "log_loss": f"{source} SELECT round(log_loss, 6) AS log_loss FROM metrics",
        "fbeta": f"""{source}, h AS (SELECT label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored)
            SELECT round(coalesce(5 * sum(label * prediction) / nullif(4 * sum(label) + sum(prediction), 0), 0), 6) AS f_beta FROM h""",
        "confusion_matrix": f"""{source}, g AS (SELECT CAST(a AS INTEGER) AS label, CAST(b AS INTEGER) AS prediction
              FROM range(2) t(a), range(2) s(b)),
            c AS (SELECT g.label, g.prediction, count(id) AS n FROM g LEFT JOIN decided d
                  ON d.label = g.label AND d.prediction = g.prediction GROUP BY g.label, g.prediction)
            SELECT label, prediction, n, round(coalesce(n / nullif(sum(n) OVER (PARTITION BY label), 0), 0), 6) AS share FROM c""",
        "calibration_curve": f"""{source} SELECT CAST(len(list_filter(range(1, 10), lambda i: i * CAST(0.1 AS DOUBLE) < s)) AS INTEGER) AS bin,
            round(avg(s), 6) AS mean_score, round(avg(label), 6) AS positive_share, count(*) AS n FROM clip GROUP BY 1""",
        "score_histogram": f"""{source}, r AS (SELECT min(s) AS low, (max(s) - min(s)) / 20 AS width FROM clip)
            SELECT CAST(least(coalesce(floor((s - low) / nullif(width, 0)), 0), 19) AS INTEGER) AS bin, count(*) AS n
            FROM clip, r GROUP BY 1""",
    }


def oracle_sql() -> dict[str, str]:
    documents = {f"{name}_documents": sql for name, sql in _evaluation(_DOCUMENT_SCORES).items()}
    gaps = {f"{name}_gaps": sql for name, sql in _statistics_queries(LONG_GAPS).items()}
    events = {f"{name}_events": sql for name, sql in _evaluation(_EVENT_SCORES).items()}
    events["left_out_events"] = f"""WITH {_EVENTS} SELECT count(*) AS rows,
        count(*) FILTER (WHERE score IS NULL OR isnan(score)) AS without_score,
        count(*) FILTER (WHERE label IS NULL) AS without_label,
        count(*) FILTER (WHERE score IS NULL OR isnan(score) OR label IS NULL) AS left_out FROM events_scored"""
    return {
        **_base_queries(), **_profile_queries(), **_statistics_queries(), **gaps, **_model_queries(),
        **_contribution_queries(), "mann_whitney_exact": _MANN_WHITNEY_EXACT, "agent_grammar": _AGENT_GRAMMAR,
        "sketch_rank_error": """SELECT event_type, share, true AS within_bound
            FROM (SELECT DISTINCT event_type FROM events),
                 (VALUES (0.05::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.95::DOUBLE)) s(share)""",
        **_evaluation(_USER_SCORES), **documents, **events, "metrics_json": _evaluation(_USER_SCORES)["metrics_long"],
    }
