"""ANSI SQL for every query, written from the table definitions for DuckDB.

Windows are plain range joins here, whatever form the Spark side uses.
"""

from __future__ import annotations

from tidemark.contracts import CATEGORIES, SPEND_WINDOWS

K = "CAST(json_extract_string(props, '$.k') AS INT)"

# The benchmark tables in the roles of the source tables.
ROLES = {
    "acct": """SELECT c_custkey AS account_id, DATE '2024-01-01' + CAST(c_custkey % 20 AS INT) AS created_at,
        n_name AS country, c_mktsegment AS install_source
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "login": """SELECT user_id AS account_id, ts AS login_ts, CAST(ts AS DATE) AS event_date
        FROM events WHERE event_type = 'view'""",
    "battle": f"""SELECT user_id AS account_id, ts AS battle_ts, CAST({K} % 2 AS INT) AS won,
        CAST(floor(value) AS INT) AS duration_seconds, CAST(ts AS DATE) AS event_date
        FROM events WHERE event_type = 'click'""",
    "purchase": f"""SELECT user_id AS account_id, ts AS purchase_ts,
        CASE {K} % 5 WHEN 0 THEN 'gems' WHEN 1 THEN 'cards' WHEN 2 THEN 'chest' WHEN 3 THEN 'pass'
        ELSE 'cosmetic' END AS category,
        CAST(value AS DECIMAL(18,2)) AS amount_usd, CAST(ts AS DATE) AS event_date
        FROM events WHERE event_type = 'purchase'""",
    "progression": """SELECT user_id AS account_id, ts AS level_up_ts,
        CAST(1 + row_number() OVER (PARTITION BY user_id ORDER BY ts) AS INT) AS new_level,
        CAST(ts AS DATE) AS event_date
        FROM events WHERE event_type = 'signup'""",
    "social": f"""SELECT user_id AS account_id, ts AS event_ts,
        CASE {K} % 3 WHEN 0 THEN 'message' WHEN 1 THEN 'invite' ELSE 'gift' END AS event_type,
        CAST(ts AS DATE) AS event_date
        FROM events WHERE event_type = 'error'""",
    "sess": f"""SELECT user_id AS account_id, ts AS session_ts, {K} AS duration_s,
        CASE WHEN {K} % 2 = 0 THEN 'ios' ELSE 'android' END AS device, CAST(ts AS DATE) AS event_date
        FROM events""",
    "clan": """SELECT DISTINCT user_id AS account_id, CAST(ts AS DATE) AS "date", user_id % 3 = 0 AS is_clan_member
        FROM events WHERE event_type = 'view'""",
    "spine": "SELECT DISTINCT event_date AS observation_date FROM login",
    "spine_seen": """SELECT observation_date FROM spine
        WHERE observation_date <= (SELECT max(observation_date) FROM spine) - INTERVAL 7 DAY""",
    "obs": "SELECT account_id, observation_date FROM acct, spine WHERE observation_date >= created_at",
    "obs_seen": "SELECT account_id, observation_date FROM acct, spine_seen WHERE observation_date >= created_at",
}


def _window(table: str, back: str, *, grid: str = "obs", ahead: str = "o.observation_date") -> str:
    lower = f"AND e.event_date >= {back}" if back else ""
    return f"""FROM {grid} o LEFT JOIN {table} e ON e.account_id = o.account_id
        {lower} AND e.event_date <= {ahead}"""


WEEK = "o.observation_date - INTERVAL 7 DAY"
BACK = "date_diff('day', e.event_date, o.observation_date)"
GROUP = "GROUP BY o.account_id, o.observation_date"
KEYS = "o.account_id, o.observation_date"


def _spend(condition: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {condition} THEN e.amount_usd END), 0) AS DOUBLE)"


PIVOT = ", ".join(
    f"{_spend(f'''e.category = '{c}' AND {BACK} <= {w - 1}''')} AS spend_{c}_{w}d"
    for c in CATEGORIES
    for w in SPEND_WINDOWS
)
TOTALS = f"""COUNT(CASE WHEN {BACK} <= 6 THEN 1 END) AS purchases_count_7d,
    {_spend(f'{BACK} <= 29')} AS purchases_amount_sum_30d,
    {_spend(f'{BACK} <= 89')} AS purchases_amount_sum_90d"""
WEEK_TOTAL = " + ".join(f"CAST(spend_{c}_7d AS DECIMAL(28,2))" for c in CATEGORIES)

# The feature tables.
TABLES = {
    "f_account": """SELECT account_id, observation_date,
        CAST(date_diff('day', created_at, observation_date) AS INT) AS account_age_days, country, install_source
        FROM acct, spine WHERE observation_date >= created_at""",
    "f_battle": f"""SELECT {KEYS}, COUNT(e.won) AS battles_7d, AVG(CAST(e.won AS DOUBLE)) AS win_rate_7d,
        AVG(CAST(e.duration_seconds AS DOUBLE)) AS avg_duration_7d {_window('battle', WEEK)} {GROUP}""",
    "f_purchase": f"""SELECT {KEYS}, {PIVOT}, {TOTALS}
        {_window('purchase', 'o.observation_date - INTERVAL 90 DAY')} {GROUP}""",
    "f_progression": f"""SELECT {KEYS}, COUNT(CASE WHEN {BACK} <= 6 THEN 1 END) AS level_ups_7d,
        COUNT(CASE WHEN {BACK} <= 29 THEN 1 END) AS level_ups_30d,
        COALESCE(MAX(e.new_level), 1) AS current_level {_window('progression', '')} {GROUP}""",
    "f_social": f"""SELECT {KEYS}, COUNT(CASE WHEN e.event_type = 'message' THEN 1 END) AS messages_7d,
        COUNT(CASE WHEN e.event_type = 'invite' THEN 1 END) AS invites_7d,
        COUNT(CASE WHEN e.event_type = 'gift' THEN 1 END) AS gifts_7d {_window('social', WEEK)} {GROUP}""",
    "f_social_enriched": """SELECT o.account_id, o.observation_date,
        COALESCE(c.is_clan_member, FALSE) AS is_clan_member
        FROM obs o LEFT JOIN clan c ON c.account_id = o.account_id AND c."date" = o.observation_date""",
    "f_session": f"""SELECT {KEYS}, COUNT(e.duration_s) AS sessions_7d,
        AVG(CAST(e.duration_s AS DOUBLE)) AS avg_session_seconds_7d,
        COUNT(CASE WHEN e.device = 'ios' THEN 1 END) AS sessions_ios_7d,
        COUNT(CASE WHEN e.device = 'android' THEN 1 END) AS sessions_android_7d {_window('sess', WEEK)} {GROUP}""",
    "f_tier": """SELECT account_id, observation_date, CASE WHEN purchases_amount_sum_30d >= 100 THEN 'whale'
        WHEN purchases_amount_sum_30d >= 20 THEN 'dolphin' WHEN purchases_amount_sum_30d > 0 THEN 'minnow'
        ELSE 'non_spender' END AS spender_tier FROM f_purchase""",
    "f_velocity": f"""SELECT account_id, observation_date, CAST({WEEK_TOTAL} AS DOUBLE) AS spend_7d_total,
        CASE WHEN purchases_amount_sum_30d > 0
        THEN CAST({WEEK_TOTAL} AS DOUBLE) / purchases_amount_sum_30d END AS spend_velocity_7d_over_30d
        FROM f_purchase""",
    "f_enriched": """SELECT p.account_id, p.observation_date, t.spender_tier = 'whale' AS is_whale,
        COALESCE(v.spend_velocity_7d_over_30d, 0) > 0.5 AS is_high_velocity,
        CAST(CASE t.spender_tier WHEN 'whale' THEN 3 WHEN 'dolphin' THEN 2 WHEN 'minnow' THEN 1 ELSE 0 END
        AS DOUBLE) * COALESCE(v.spend_velocity_7d_over_30d, CAST(0 AS DOUBLE)) * p.purchases_amount_sum_30d
        AS enriched_spend_score
        FROM f_purchase p JOIN f_tier t USING (account_id, observation_date)
        JOIN f_velocity v USING (account_id, observation_date)""",
    "labels": f"""SELECT {KEYS}, COUNT(e.login_ts) > 0 AS did_login_within_7d
        {_window('login', 'o.observation_date + INTERVAL 1 DAY', grid='obs_seen',
                 ahead='o.observation_date + INTERVAL 7 DAY')} {GROUP}""",
    "eligible": """SELECT DISTINCT l.account_id, m.d AS observation_date
        FROM login l, (SELECT max(event_date) AS d FROM login) m
        WHERE l.event_date >= m.d - INTERVAL 30 DAY AND l.event_date <= m.d""",
}

CHURN = """a.account_age_days, b.win_rate_7d, p.purchases_count_7d, g.level_ups_7d, g.current_level,
    c.is_clan_member, s.messages_7d, e.sessions_7d, e.avg_session_seconds_7d"""
PIT_JOINS = "\n".join(
    f"ASOF LEFT JOIN {table} {a} ON {a}.account_id = x.account_id AND x.observation_date >= {a}.observation_date"
    for table, a in [
        ("f_account", "a"),
        ("f_battle", "b"),
        ("f_purchase", "p"),
        ("f_progression", "g"),
        ("f_social_enriched", "c"),
        ("f_social", "s"),
        ("f_session", "e"),
    ]
)
# Restatement dates: whole days at a quarter, half and three quarters of the login span.
RESTATED = """restated AS (SELECT lo + CAST(floor(span * q) AS INT) AS d
    FROM (SELECT min(event_date) AS lo, date_diff('day', min(event_date), max(event_date)) AS span FROM login),
         (VALUES (0.25), (0.5), (0.75)) AS t(q))"""
SPEND = """spend AS (SELECT account_id, CAST(SUM(amount_usd) AS DOUBLE) AS spend, COUNT(*) AS purchases
    FROM purchase GROUP BY account_id),
    acct_spend AS (SELECT acct.account_id, spend, purchases FROM acct LEFT JOIN spend USING (account_id))"""
SOCIAL_RESTATED = f"""{RESTATED}, social2 AS (
    SELECT account_id, event_ts, event_type, event_date FROM social
    WHERE event_date NOT IN (SELECT d FROM restated)
    UNION ALL SELECT account_id, login_ts, 'message', event_date FROM login
    WHERE event_date IN (SELECT d FROM restated))"""


def _sql(body: str, *extra: str, quarters: bool = False) -> str:
    """``body`` with the role and table definitions it may use; DuckDB ignores unused ones.

    With ``quarters`` amounts are doubles in whole quarters.
    """
    roles = dict(ROLES)
    if quarters:
        roles["purchase"] = f"SELECT * REPLACE (CAST(floor(amount_usd * 4) AS DOUBLE) / 4 AS amount_usd) FROM ({ROLES['purchase']})"
    ctes = [f"{name} AS ({text})" for name, text in {**roles, **TABLES}.items()]
    return f"WITH {', '.join([*ctes, *extra])} {body}"


def _bucket(text: str, n: int) -> str:
    """Bucket of the first 60 bits of an MD5 digest, digit by digit."""
    digits = " + ".join(
        f"CAST(strpos('0123456789abcdef', substr(md5({text}), {i}, 1)) - 1 AS BIGINT) * {16 ** (15 - i)}"
        for i in range(1, 16)
    )
    return f"CAST(({digits}) % {n} AS INT)"


def _rules() -> dict:
    """Every table's rules by table, with the name of its definition."""
    return {
        ("account", "f_account"): {"nonneg_account_age": "account_age_days IS NULL OR account_age_days >= 0"},
        ("battle", "f_battle"): {
            "valid_win_rate": "win_rate_7d IS NULL OR win_rate_7d BETWEEN 0 AND 1",
            "nonneg_duration": "avg_duration_7d IS NULL OR avg_duration_7d >= 0",
        },
        ("purchase", "f_purchase"): {},
        ("progression", "f_progression"): {
            "valid_level": "current_level >= 1",
            "nonneg_level_ups": "level_ups_7d >= 0 AND level_ups_30d >= 0",
            "consistent_levelup_windows": "level_ups_7d <= level_ups_30d",
        },
        ("social", "f_social"): {"nonneg_event_counts": "least(messages_7d, invites_7d, gifts_7d) >= 0"},
        ("social_enriched", "f_social_enriched"): {},
        ("session", "f_session"): {
            "nonneg_sessions": "least(sessions_7d, sessions_ios_7d, sessions_android_7d) >= 0",
            "nonneg_session_seconds": "avg_session_seconds_7d IS NULL OR avg_session_seconds_7d >= 0",
            "device_split_subset": "sessions_ios_7d + sessions_android_7d <= sessions_7d",
        },
        ("spender_tier", "f_tier"): {
            "valid_tier_value": "spender_tier IN ('whale', 'dolphin', 'minnow', 'non_spender')"
        },
        ("purchase_velocity", "f_velocity"): {
            "nonneg_spend_total": "spend_7d_total IS NULL OR spend_7d_total >= 0",
            "velocity_in_range": "spend_velocity_7d_over_30d IS NULL OR spend_velocity_7d_over_30d BETWEEN 0 AND 1",
        },
        ("purchase_enriched", "f_enriched"): {
            "nonneg_score": "enriched_spend_score IS NULL OR enriched_spend_score >= 0"
        },
    }


def _checks() -> str:
    """Violation counts of every table's rules, one row each."""
    rules = _rules()
    keyed = "account_id IS NOT NULL AND observation_date IS NOT NULL"
    parts = []
    for (name, table), checks in rules.items():
        for check, rule in {**checks, "keys_not_null": keyed}.items():
            parts.append(
                f"SELECT '{name}' AS table_name, '{check}' AS check_name, COUNT(*) AS row_count, "
                f"COUNT(CASE WHEN ({rule}) THEN NULL ELSE 1 END) AS violations FROM {table}"
            )
    return " UNION ALL ".join(parts)


def _checks_with_unique(tables: dict[str, str]) -> str:
    """Violation counts of the given tables (name to definition) with keys that must be there once."""
    keyed = "account_id IS NOT NULL AND observation_date IS NOT NULL"
    parts = []
    for (name, _), checks in _rules().items():
        if name in tables:
            for check, rule in {**checks, "keys_not_null": keyed}.items():
                parts.append(
                    f"SELECT '{name}' AS table_name, '{check}' AS check_name, COUNT(*) AS row_count, "
                    f"COUNT(CASE WHEN ({rule}) THEN NULL ELSE 1 END) AS violations FROM {tables[name]}"
                )
            parts.append(
                f"SELECT '{name}' AS table_name, 'keys_unique' AS check_name, CAST(SUM(c) AS BIGINT) AS row_count, "
                f"CAST(SUM(c - 1) AS BIGINT) AS violations "
                f"FROM (SELECT COUNT(*) AS c FROM {tables[name]} GROUP BY account_id, observation_date)"
            )
    return " UNION ALL ".join(parts)


# Columns overwritten in the rows of accounts with a remainder modulo 11.
_DAMAGE = {
    "account": "CASE WHEN r = 1 THEN -1 ELSE account_age_days END AS account_age_days",
    "battle": "CASE WHEN r = 1 THEN 2 ELSE win_rate_7d END AS win_rate_7d, "
    "CASE WHEN r = 2 THEN -1 ELSE avg_duration_7d END AS avg_duration_7d",
    "progression": "CASE WHEN r = 1 THEN 0 ELSE current_level END AS current_level, "
    "CASE WHEN r = 2 THEN -1 WHEN r = 3 THEN level_ups_30d + 1 ELSE level_ups_7d END AS level_ups_7d",
    "social": "CASE WHEN r = 1 THEN -1 ELSE gifts_7d END AS gifts_7d",
    "session": "CASE WHEN r = 1 THEN -1 ELSE sessions_7d END AS sessions_7d, "
    "CASE WHEN r = 2 THEN -1 ELSE avg_session_seconds_7d END AS avg_session_seconds_7d, "
    "CASE WHEN r = 3 THEN sessions_7d + 1 ELSE sessions_ios_7d END AS sessions_ios_7d",
    "spender_tier": "CASE WHEN r = 1 THEN 'tin' ELSE spender_tier END AS spender_tier",
    "purchase_velocity": "CASE WHEN r = 1 THEN -1 ELSE spend_7d_total END AS spend_7d_total, "
    "CASE WHEN r = 2 THEN 1.5 ELSE spend_velocity_7d_over_30d END AS spend_velocity_7d_over_30d",
    "purchase_enriched": "CASE WHEN r = 1 THEN -1 ELSE enriched_spend_score END AS enriched_spend_score",
}


def _damaged() -> list[str]:
    """A damaged version ``x_<table>`` of every feature table."""
    out = []
    for name, table in _rules():
        changed = _DAMAGE.get(name, "")
        columns = ["CASE WHEN r = 5 THEN NULL ELSE account_id END AS account_id", *([changed] if changed else [])]
        out.append(
            f"x_{name} AS (SELECT * REPLACE ({', '.join(columns)}) FROM (SELECT *, account_id % 11 AS r FROM "
            f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE account_id % 11 = 6)))"
        )
    return out


_LOGS = {"login": "login", "battle": "battle", "purchase": "purchase", "progression": "progression",
         "social": "social", "session": "sess"}
_STAMP = {"login": "login_ts", "battle": "battle_ts", "purchase": "purchase_ts", "progression": "level_up_ts",
          "social": "event_ts", "session": "session_ts"}


def oracle_sql() -> dict[str, str]:
    sql = {
        "date_spine": _sql("SELECT observation_date FROM spine"),
        "date_spine_observable": _sql("SELECT observation_date FROM spine_seen"),
        "observable_spine": _sql("SELECT observation_date FROM spine_seen"),
        "feat_account": _sql("SELECT * FROM f_account"),
        "feat_battle": _sql("SELECT * FROM f_battle"),
        "feat_purchase": _sql("SELECT * FROM f_purchase"),
        "feat_progression": _sql("SELECT * FROM f_progression"),
        "feat_social": _sql("SELECT * FROM f_social"),
        "feat_social_enriched": _sql("SELECT * FROM f_social_enriched"),
        "feat_session": _sql("SELECT * FROM f_session"),
        "spender_tier": _sql("SELECT * FROM f_tier"),
        "purchase_velocity": _sql("SELECT * FROM f_velocity"),
        "feat_purchase_enriched": _sql("SELECT * FROM f_enriched"),
        "label_login_7d": _sql("SELECT * FROM labels"),
        "eligibility_prediction": _sql("SELECT * FROM eligible"),
        "all_features": _sql(
            """SELECT * FROM f_account JOIN f_battle USING (account_id, observation_date)
            JOIN f_purchase USING (account_id, observation_date)
            JOIN f_progression USING (account_id, observation_date)
            JOIN f_social USING (account_id, observation_date)
            JOIN f_social_enriched USING (account_id, observation_date)
            JOIN f_session USING (account_id, observation_date)
            JOIN f_enriched USING (account_id, observation_date)"""
        ),
        # joins
        "observation_grid": _sql("SELECT * FROM obs"),
        "trailing_range_join": _sql(
            f"SELECT {KEYS}, e.event_date, e.won, e.duration_seconds {_window('battle', WEEK)}"
        ),
        "trailing_range_join_90d": _sql(
            f"""SELECT {KEYS}, e.event_date, e.category, CAST(e.amount_usd AS DOUBLE) AS amount_usd,
            CAST({BACK} AS INT) AS days_back {_window('purchase', 'o.observation_date - INTERVAL 90 DAY')}"""
        ),
        "history_to_date_join": _sql(f"SELECT {KEYS}, e.event_date, e.new_level {_window('progression', '')}"),
        "forward_range_join": _sql(
            f"""SELECT {KEYS}, e.event_date
            {_window('login', 'o.observation_date + INTERVAL 1 DAY', grid='obs_seen',
                     ahead='o.observation_date + INTERVAL 7 DAY')}"""
        ),
        "range_only_join": _sql(
            """SELECT account_id, event_date, d AS observation_date
            FROM login, (SELECT max(event_date) AS d FROM login) m
            WHERE event_date BETWEEN d - INTERVAL 30 DAY AND d"""
        ),
        "fan_in_join": _sql(
            """SELECT account_id, observation_date, purchases_amount_sum_30d, spender_tier,
            spend_7d_total, spend_velocity_7d_over_30d FROM f_purchase
            LEFT JOIN f_tier USING (account_id, observation_date)
            LEFT JOIN f_velocity USING (account_id, observation_date)"""
        ),
        "snapshot_join": _sql(
            """SELECT o.account_id, o.observation_date, c.is_clan_member FROM obs o
            LEFT JOIN clan c ON c.account_id = o.account_id AND c."date" = o.observation_date"""
        ),
        "point_in_time_join": _sql(
            """SELECT x.account_id, x.observation_date, x.did_login_within_7d, f.battles, f.wins, f.long_battles
            FROM labels x ASOF LEFT JOIN active f
            ON f.account_id = x.account_id AND x.observation_date >= f.event_date""",
            """active AS (SELECT account_id, event_date, COUNT(won) AS battles, CAST(SUM(won) AS BIGINT) AS wins,
            CAST(SUM(CASE WHEN duration_seconds >= 60 THEN 1 END) AS BIGINT) AS long_battles
            FROM battle GROUP BY account_id, event_date)""",
        ),
        "point_in_time_join_repeated_spine": _sql(
            """SELECT x.account_id, x.observation_date, x.battle_ts,
            CASE WHEN date_diff('day', f.event_date, x.observation_date) <= 5 THEN f.spent END AS spent
            FROM (SELECT account_id, event_date AS observation_date, battle_ts FROM battle) x
            ASOF LEFT JOIN day_spend f ON f.account_id = x.account_id AND x.observation_date >= f.event_date""",
            """day_spend AS (SELECT account_id, event_date, CAST(SUM(amount_usd) AS DOUBLE) AS spent
            FROM purchase GROUP BY account_id, event_date)""",
        ),
        "attach_last_state": _sql(
            """SELECT account_id, COALESCE(MAX(new_level), 1) AS max_level
            FROM acct LEFT JOIN progression USING (account_id) GROUP BY account_id"""
        ),
        "grid_for_dates": _sql(
            "SELECT account_id, d AS event_date FROM acct, restated WHERE d >= created_at", RESTATED
        ),
        "grid_in_interval": _sql(
            """SELECT a.account_id, observation_date FROM acct a
            LEFT JOIN (SELECT account_id, MAX(event_date) AS end_date FROM battle GROUP BY account_id) b
            ON a.account_id = b.account_id, spine
            WHERE observation_date >= created_at AND (end_date IS NULL OR observation_date < end_date)"""
        ),
        # aggregations
        "distinct_dates": _sql("SELECT DISTINCT event_date FROM battle"),
        "distinct_rows": _sql("SELECT DISTINCT account_id, event_date FROM login"),
        "global_minmax": _sql("SELECT MIN(event_date) AS first_date, MAX(event_date) AS last_date FROM login"),
        "count_nonnull": _sql("SELECT account_id, observation_date, battles_7d FROM f_battle"),
        "avg_as_double": _sql("SELECT account_id, observation_date, win_rate_7d, avg_duration_7d FROM f_battle"),
        "conditional_count": _sql("SELECT * FROM f_social"),
        "session_counts_by_join": _sql("SELECT * FROM f_session"),
        "max_with_default": _sql("SELECT * FROM f_progression"),
        "any_in_window": _sql("SELECT * FROM labels"),
        "spend_pivot": _sql(
            "SELECT account_id, observation_date, "
            + ", ".join(f"spend_{c}_{w}d" for c in CATEGORIES for w in SPEND_WINDOWS)
            + " FROM f_purchase"
        ),
        "spend_in_doubles": _sql("SELECT * FROM f_purchase", quarters=True),
        "enriched_in_doubles": _sql("SELECT * FROM f_enriched", quarters=True),
        "spend_totals": _sql(
            """SELECT account_id, observation_date, purchases_count_7d, purchases_amount_sum_30d,
            purchases_amount_sum_90d FROM f_purchase"""
        ),
        "spend_by_category_and_date": _sql(
            "SELECT account_id, event_date, "
            + ", ".join(
                f"CAST(COALESCE(SUM(CASE WHEN category = '{c}' THEN amount_usd END), 0) AS DOUBLE) AS \"{c}\""
                for c in CATEGORIES
            )
            + " FROM purchase GROUP BY account_id, event_date"
        ),
        "max_per_key": _sql("SELECT account_id, MAX(new_level) AS max_level FROM progression GROUP BY account_id"),
        "rows_by_table_and_date": _sql(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, event_date, COUNT(*) AS row_count FROM {cte} GROUP BY event_date"
                for name, cte in _LOGS.items()
            )
        ),
        # numbering and latest rows
        "running_level": _sql("SELECT account_id, level_up_ts, new_level FROM progression"),
        "continue_level": _sql(
            """SELECT account_id, level_up_ts, new_level FROM progression
            WHERE event_date = (SELECT MAX(event_date) FROM progression)"""
        ),
        "latest_row_per_key": _sql(
            """SELECT account_id, "date", is_clan_member FROM clan
            QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY "date" DESC) = 1"""
        ),
        "running_level_by_range": _sql("SELECT account_id, level_up_ts, new_level FROM progression"),
        "busiest_account_numbered": _sql(
            """SELECT account_id AS visitor, event_date, row_number() OVER (ORDER BY account_id, event_date) AS number
            FROM sess"""
        ),
        # projections and scalar functions
        "created_filter": _sql(
            """SELECT account_id, login_ts, created_at AS since FROM login JOIN acct USING (account_id)
            WHERE event_date >= created_at"""
        ),
        "tier_case": _sql(
            """SELECT account_id, tier,
            CAST(CASE tier WHEN 'whale' THEN 3 WHEN 'dolphin' THEN 2 WHEN 'minnow' THEN 1 ELSE 0 END AS DOUBLE)
            AS weight, tier = 'whale' AS is_whale, COALESCE(spend >= 100, FALSE) AS over_100,
            CASE WHEN spend >= 100 THEN TRUE END AS whale_or_unknown
            FROM (SELECT *, CASE WHEN spend >= 100 THEN 'whale' WHEN spend >= 20 THEN 'dolphin'
                  WHEN spend > 0 THEN 'minnow' ELSE 'non_spender' END AS tier FROM acct_spend)""",
            SPEND,
        ),
        "guarded_ratio": _sql(
            """SELECT account_id,
            CASE WHEN COALESCE(purchases, 0) > 0 THEN spend / purchases END AS spend_per_purchase,
            CASE WHEN spend > 0 THEN COALESCE(purchases, 0) / spend END AS purchases_per_dollar,
            COALESCE(spend, 0) + COALESCE(purchases, 0) AS spend_plus_count,
            spend + purchases AS spend_plus_count_or_null FROM acct_spend""",
            SPEND,
        ),
        "feature_score": _sql(
            """SELECT account_id, share > 0.5 AS is_high,
            CAST(CASE WHEN spend >= 100 THEN 3 WHEN spend >= 20 THEN 2 WHEN spend > 0 THEN 1 ELSE 0 END AS DOUBLE)
            * share * COALESCE(spend, CAST(0 AS DOUBLE)) AS score
            FROM (SELECT *, CASE WHEN spend > 0 THEN CAST(50 AS DOUBLE) / spend ELSE CAST(0 AS DOUBLE) END AS share
                  FROM acct_spend)""",
            SPEND,
        ),
        "row_predicates": _sql(
            """SELECT account_id, purchase_ts, category, CAST(amount_usd AS DOUBLE) AS amount_usd FROM purchase
            WHERE (category IN ('gems', 'pass') AND amount_usd BETWEEN 5 AND 50)
            OR category IS NULL OR category NOT IN ('gems', 'cards', 'chest', 'pass')"""
        ),
        "struct_fields": _sql("SELECT account_id, event_date, duration_s, device FROM sess"),
        "json_payload": _sql(
            """SELECT account_id, session_ts, '{"duration_s":' || CAST(duration_s AS VARCHAR) || ',"device":"'
            || device || '","level_reached":1}' AS payload_json FROM sess"""
        ),
        "date_functions": _sql(
            """SELECT account_id, login_ts, CAST(date_diff('day', created_at, event_date) AS INT) AS age_days,
            CAST(event_date + INTERVAL 7 DAY AS DATE) AS week_later,
            CAST(event_date - INTERVAL 30 DAY AS DATE) AS month_before,
            created_at + CAST(day(event_date) AS INT) AS shifted,
            CAST(event_date AS TIMESTAMP) + INTERVAL 90 SECOND AS second_90, CAST(login_ts AS DATE) AS login_day
            FROM login JOIN acct USING (account_id)"""
        ),
        "scalar_functions": _sql(
            """SELECT account_id, purchase_ts, CAST(round(amount_usd, 1) AS DOUBLE) AS rounded,
            greatest(0, CAST(floor(amount_usd) AS INT) - 20) AS over_20, CAST(floor(amount_usd) AS INT) AS whole,
            amount_usd > 20 AS is_large,
            COALESCE(CASE WHEN amount_usd > 20 THEN category END, 'small') AS large_category FROM purchase"""
        ),
        "expand_rows": _sql(
            """SELECT account_id, battle_ts, CAST(copy AS INT) AS copy
            FROM (SELECT *, unnest(generate_series(1, duration_seconds // 10)) AS copy FROM battle
                  WHERE duration_seconds >= 10)"""
        ),
        "interval_to_daily": _sql(
            """SELECT account_id, observation_date,
            COALESCE(start_date IS NOT NULL AND observation_date >= start_date
                     AND (end_date IS NULL OR observation_date < end_date), FALSE) AS is_clan_member
            FROM acct
            LEFT JOIN (SELECT account_id, MAX(event_date) AS end_date FROM battle GROUP BY account_id)
            USING (account_id)
            LEFT JOIN (SELECT account_id, MIN(event_date) AS start_date FROM login GROUP BY account_id)
            USING (account_id), spine"""
        ),
        "hash_bucket": _sql(
            f"""SELECT account_id, bucket, CASE WHEN bucket < 20 THEN 'whale' WHEN bucket < 45 THEN 'dolphin'
            WHEN bucket < 75 THEN 'minnow' ELSE 'non_spender' END AS spender_class, install_source
            FROM (SELECT account_id, {_bucket("account_id || '|spender_class'", 100)} AS bucket,
                  list_extract(['organic', 'paid', 'referral'],
                  {_bucket("CAST(account_id AS VARCHAR)", 3)} + 1) AS install_source FROM acct)"""
        ),
        # quality
        "quality_counts": _sql(_checks()),
        "checks_on_write": _sql(_checks_with_unique({name: f"x_{name}" for name, _ in _rules()}), *_damaged()),
        "checks_kept": _sql(
            _checks_with_unique({
                "battle": "f_battle", "social_enriched": "x_clan", "purchase_enriched": "f_enriched",
                "spender_tier": "f_tier", "purchase_velocity": "f_velocity",
            }),
            """x_clan AS (SELECT * FROM f_social_enriched UNION ALL SELECT f.* FROM f_social_enriched f
            JOIN clan c ON c.account_id = f.account_id AND c."date" = f.observation_date WHERE f.account_id % 5 = 0)""",
        ),
        "repeated_keys": _sql(
            """SELECT account_id, event_date, COUNT(*) AS row_count FROM login
            GROUP BY account_id, event_date HAVING COUNT(*) > 1"""
        ),
        "misdated_counts": _sql(
            " UNION ALL ".join(
                f"""SELECT '{name}' AS log, COUNT(*) AS row_count,
                COUNT(CASE WHEN CAST({_STAMP[name]} AS DATE) <> event_date THEN 1 END) AS misdated FROM {cte}"""
                for name, cte in _LOGS.items()
            )
        ),
        # stored tables
        "next_batch_date": _sql("SELECT MAX(event_date) + 1 AS next_date FROM login"),
        "carry_forward_snapshot": _sql(
            """SELECT account_id, d AS "date", COALESCE(is_clan_member, FALSE) AS is_clan_member
            FROM acct LEFT JOIN (SELECT account_id, is_clan_member FROM clan
                QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY "date" DESC) = 1)
            USING (account_id), (SELECT MAX(event_date) + 1 AS d FROM login) WHERE created_at <= d"""
        ),
        "append_batch": _sql("SELECT account_id, login_ts, event_date FROM login"),
        "restate_dates": _sql("SELECT account_id, event_ts, event_type, event_date FROM social2", SOCIAL_RESTATED),
        "restated_view": _sql("SELECT account_id, event_ts, event_type, event_date FROM social2", SOCIAL_RESTATED),
        "appended_view": _sql("SELECT account_id, event_date FROM login"),
        "delete_dates": _sql(
            """SELECT account_id, session_ts, event_date FROM sess
            WHERE event_date NOT IN (SELECT d FROM restated)""",
            RESTATED,
        ),
        "append_rows": _sql(
            "SELECT account_id, event_date FROM login UNION ALL SELECT account_id, event_date FROM battle"
        ),
        "published_table": _sql("SELECT * FROM f_battle"),
        "refresh_slice": _sql(
            f"""SELECT {KEYS}, COUNT(CASE WHEN e.event_type = 'message' THEN 1 END) AS messages_7d,
            COUNT(CASE WHEN e.event_type = 'invite' THEN 1 END) AS invites_7d,
            COUNT(CASE WHEN e.event_type = 'gift' THEN 1 END) AS gifts_7d {_window('social2', WEEK)} {GROUP}""",
            SOCIAL_RESTATED,
        ),
        "feature_slice": _sql(
            "SELECT * FROM f_progression WHERE observation_date IN (SELECT d FROM restated)", RESTATED
        ),
        "feature_slice_from_state": _sql(
            """SELECT * FROM f_progression WHERE observation_date > (SELECT observation_date
            FROM (SELECT *, row_number() OVER (ORDER BY observation_date) - 1 AS i, COUNT(*) OVER () AS n FROM spine)
            WHERE i = n // 2)"""
        ),
        "refresh_by_parts": _sql(
            "SELECT * FROM f_battle JOIN f_progression USING (account_id, observation_date)"
        ),
        "stored_prediction_after_append": _sql(
            f"""SELECT x.account_id, x.observation_date, a.account_age_days, b.win_rate_7d, g.level_ups_7d,
            g.current_level, s.messages_7d FROM eligible x {PIT_JOINS}"""
        ),
        "refresh_new_accounts": _sql("SELECT * FROM f_battle"),
        "registered_table": _sql("SELECT * FROM f_battle"),
    }
    sql["carried_snapshot"] = sql["carry_forward_snapshot"]
    training = _sql(
        f"SELECT x.account_id, x.observation_date, {CHURN}, x.did_login_within_7d FROM labels x {PIT_JOINS}"
    )
    prediction = _sql(f"SELECT x.account_id, x.observation_date, {CHURN} FROM eligible x {PIT_JOINS}")
    sql |= {
        "training_set": training,
        "training_set_point_in_time": training,
        "dataset_by_path": training,
        "prediction_set": prediction,
        "prediction_set_point_in_time": prediction,
    }
    return sql
