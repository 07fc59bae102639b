"""SQL that states the expected result of each query, for an independent engine.

Written in DuckDB's dialect over the same tables. The feed is rebuilt from ``events``
without going through JSON wherever the query does not return JSON text.
"""

from __future__ import annotations

from eventlake.plans.queries import DAY, LATE_BOUNDS, RANGE, SINCE

# Fixed values, stated here again so that the shipped configuration is checked against them.
_COUNTRY_NAMES = {
    "US": "United States",
    "UK": "United Kingdom",
    "BR": "Brazil",
    "JP": "Japan",
    "DE": "Germany",
    "FR": "France",
    "IN": "India",
    "CN": "China",
    "CA": "Canada",
    "AU": "Australia",
}
_PRODUCT_NAMES = {
    "PROD001": "Coin Pack Small",
    "PROD002": "Coin Pack Medium",
    "PROD003": "Coin Pack Large",
    "PROD004": "Premium Pass",
    "PROD005": "VIP Membership",
    "PROD006": "Coin Pack Mega",
    "PROD007": "Coin Pack Ultimate",
    "PROD008": "Starter Pack",
    "PROD009": "Boost Pack",
    "PROD010": "Special Offer",
}


def _case(column: str, names: dict[str, str], default: str) -> str:
    branches = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    return f"CASE {column} {branches} ELSE '{default}' END"


def _user(number: str) -> str:
    return f"'user_' || lpad(cast({number} AS varchar(20)), 6, '0')"


def _window(second: str, width: int) -> str:
    """Start of the tumbling window that holds an epoch second."""
    return f"make_timestamp(({second} // {width}) * {width} * 1000000)"


_RAW = f"""
raw AS (
  SELECT *, epoch_us(ts) // 1000 AS ms,
         cast(json_extract_string(props, '$.k') AS integer) AS k,
         ['US','UK','BR','JP','DE','FR','IN','CN','CA','AU','ZZ'][user_id % 11 + 1] AS country,
         ['iOS','Android','Web'][event_id % 3 + 1] AS platform
  FROM events
),
feed AS (
  SELECT *, {_user("user_id")} AS uid, {_user("user_id + 1 + k")} AS uid_b,
         ['iPhone 14','Galaxy S23','Chrome'][k % 3 + 1] AS device,
         ['iOS','Android','Web'][(event_id + k) % 3 + 1] AS played_on,
         'PROD' || lpad(cast(k % 12 + 1 AS varchar(20)), 3, '0') AS product,
         CASE event_type WHEN 'click' THEN 'match_events'
              WHEN 'purchase' THEN 'purchase_events' ELSE 'init_events' END AS topic,
         make_timestamp((ms // 1000) * 1000000) AS event_ts, ms // 1000 AS sec
  FROM raw
),
init AS (
  SELECT *, {_case("country", _COUNTRY_NAMES, "Unknown")} AS country_name
  FROM feed WHERE event_type IN ('signup', 'view')
),
game AS (SELECT * FROM feed WHERE event_type = 'click'),
purchase AS (
  SELECT *, {_case("product", _PRODUCT_NAMES, "Unknown Product")} AS product_name
  FROM feed WHERE event_type = 'purchase'
)
"""


def _payload(with_invalid: bool) -> str:
    """JSON text of each event, optionally with the planted violations."""
    fault = "event_id % 97" if with_invalid else "0"
    time = f"CASE WHEN {fault} = 1 THEN -1 ELSE ms END"
    extra = f"CASE WHEN {fault} = 2 THEN ',\"extra\":1' ELSE '' END"
    post = (
        "'{\"coin-balance-after-match\":' || (k * 100) || ',\"level-after-match\":' || (k + 1)"
        " || ',\"device\":\"' || device || '\",\"platform\":\"' || played_on || '\"}'"
    )
    return f"""
payload AS (
  SELECT *, CASE
    WHEN event_type IN ('signup', 'view') THEN
      '{{"event-type":"init","time":' || ({time}) || ',"user-id":"' || uid || '"'
      || CASE WHEN {fault} = 4 THEN '' ELSE ',"country":"' || country || '"' END
      || ',"platform":"' || platform || '"' || {extra} || '}}'
    WHEN event_type = 'click' THEN
      '{{"event-type":"match","time":' || ({time}) || ',"user-a":"' || uid || '","user-b":"'
      || uid_b || '","user-a-postmatch-info":' || {post}
      || CASE WHEN event_id % 7 = 0 THEN '' ELSE ',"user-b-postmatch-info":' || {post} END
      || ',"winner":"' || CASE WHEN event_id % 2 = 0 THEN uid ELSE uid_b END
      || '","game-tier":' || CASE WHEN {fault} = 3 THEN 9 ELSE k % 5 + 1 END
      || ',"duration":' || (30 + k * 5) || {extra} || '}}'
    WHEN event_type = 'purchase' THEN
      '{{"event-type":"in-app-purchase","time":' || ({time}) || ',"purchase_value":' || value
      || ',"user-id":"' || uid || '","product-id":"' || product || '"' || {extra} || '}}'
    ELSE '{{bad' END AS event_json
  FROM feed
)"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([_RAW, *ctes]) + body


# Unified payload columns of one event type; the rest of the 14 stay null.
_EMPTY = {
    "event-type": "varchar",
    "time": "bigint",
    "user-id": "varchar",
    "country": "varchar",
    "platform": "varchar",
    "user-a": "varchar",
    "user-b": "varchar",
    "winner": "varchar",
    "game-tier": "integer",
    "duration": "integer",
    "purchase_value": "double",
    "product-id": "varchar",
    "user-a-postmatch-info": "varchar",
    "user-b-postmatch-info": "varchar",
}
_POST = (
    "'{\"coin-balance-after-match\":' || (k * 100) || ',\"level-after-match\":' || (k + 1)"
    " || ',\"device\":\"' || device || '\",\"platform\":\"' || played_on || '\"}'"
)
_INIT = {
    "event-type": "'init'",
    "time": "ms",
    "user-id": "uid",
    "country": "country",
    "platform": "platform",
}
_GAME = {
    "event-type": "'match'",
    "time": "ms",
    "user-a": "uid",
    "user-b": "uid_b",
    "winner": "CASE WHEN event_id % 2 = 0 THEN uid ELSE uid_b END",
    "game-tier": "k % 5 + 1",
    "duration": "30 + k * 5",
    "user-a-postmatch-info": _POST,
    "user-b-postmatch-info": f"CASE WHEN event_id % 7 <> 0 THEN {_POST} END",
}
_PURCHASE = {
    "event-type": "'in-app-purchase'",
    "time": "ms",
    "user-id": "uid",
    "purchase_value": "value",
    "product-id": "product",
}


def _unified(values: dict[str, str]) -> str:
    return ", ".join(
        f'cast({values.get(name, "NULL")} AS {kind}) AS "{name}"' for name, kind in _EMPTY.items()
    )


def _when_b(expression: str) -> str:
    return f"CASE WHEN event_id % 7 <> 0 THEN {expression} END"


_FLAT = {
    "user_a_coin_balance": "k * 100",
    "user_a_level": "k + 1",
    "user_a_device": "device",
    "user_a_platform_orig": "played_on",
    "user_b_coin_balance": _when_b("k * 100"),
    "user_b_level": _when_b("k + 1"),
    "user_b_device": _when_b("device"),
    "user_b_platform_orig": _when_b("played_on"),
}
_PLATFORMS = {
    "user_a_platform": "upper(played_on)",
    "user_b_platform": _when_b("upper(played_on)"),
}


def _list(columns: dict[str, str]) -> str:
    return ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())


def _silver(table: str) -> str:
    if table == "init":
        columns = _unified(_INIT | {"platform": "upper(platform)"}) + ", country_name"
        return f"SELECT {columns}, ts AS kafka_timestamp FROM init"
    if table == "match":
        columns = ", ".join([_unified(_GAME), _list(_FLAT), _list(_PLATFORMS)])
        return f"SELECT {columns}, ts AS kafka_timestamp FROM game"
    return f"SELECT {_unified(_PURCHASE)}, product_name, ts AS kafka_timestamp FROM purchase"


_PARSED = f"""
SELECT {_unified(_INIT)}, ts AS kafka_timestamp FROM init
UNION ALL SELECT {_unified(_GAME)}, ts FROM game
UNION ALL SELECT {_unified(_PURCHASE)}, ts FROM purchase
UNION ALL SELECT {_unified({})}, ts FROM feed WHERE event_type = 'error'
"""

_KAFKA_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def _member(name: str, value: str, text: bool = True) -> str:
    """One JSON member, led by a comma; a null value leaves it out."""
    quote = '"' if text else ""
    return f"coalesce(',\"{name}\":{quote}' || ({value}) || '{quote}', '')"


def _silver_json() -> str:
    def row(values: dict[str, str], texts: set[str]) -> str:
        members = [_member(name, value, name in texts) for name, value in values.items()]
        return "'{' || substr(" + " || ".join(members) + ", 2) || '}'"

    text = {
        "event-type",
        "user-id",
        "country",
        "platform",
        "user-a",
        "user-b",
        "winner",
        "product-id",
        "kafka_timestamp",
        "country_name",
        "product_name",
        *(name for name in (_FLAT | _PLATFORMS) if "device" in name or "platform" in name),
    }
    kafka = {"kafka_timestamp": _KAFKA_TIME}
    init = _INIT | {"platform": "upper(platform)"} | kafka | {"country_name": "country_name"}
    purchase = {
        name: _PURCHASE[name] for name in _EMPTY if name in _PURCHASE
    } | kafka | {"product_name": "product_name"}
    return f"""
SELECT {row(init, text)} AS value FROM init
UNION ALL SELECT {row(_GAME | kafka | _FLAT | _PLATFORMS, text)} FROM game
UNION ALL SELECT {row(purchase, text)} FROM purchase"""


# Validation written with DuckDB's JSON functions over the payload text.
def _ok(path: str, kind: str, low: int, high: int | None = None) -> str:
    json_type = f"json_type(event_json, '{path}')"
    text = f"json_extract_string(event_json, '{path}')"
    upper = "" if high is None else f" AND {{0}} <= {high}"
    if kind == "string":
        return (
            f"({json_type} = 'VARCHAR' AND length({text}) >= {low}"
            + upper.format(f"length({text})")
            + ")"
        )
    types = "('UBIGINT','BIGINT')" if kind == "integer" else "('UBIGINT','BIGINT','DOUBLE')"
    number = f"try_cast({text} AS double)"
    return f"({json_type} IN {types} AND {number} >= {low}" + upper.format(number) + ")"


def _check(name: str, ok: str, required: bool = True, parent: str | None = None) -> str:
    path = f'$."{parent}"."{name}"' if parent else f'$."{name}"'
    label = f"{parent}.{name}" if parent else name
    absent = f"NOT json_exists(event_json, '{path}')"
    missing = f"WHEN {absent} THEN " + (f"'{label}: missing'" if required else "NULL")
    check = f"CASE {missing} WHEN NOT coalesce({ok}, false) THEN '{label}: invalid' END"
    if parent:
        check = f"CASE WHEN json_type(event_json, '$.\"{parent}\"') = 'OBJECT' THEN {check} END"
    return check


def _simple(name: str, kind: str, low: int, high: int | None = None) -> str:
    return _check(name, _ok(f'$."{name}"', kind, low, high))


def _keys(allowed: list[str], parent: str | None = None) -> str:
    """List of violations, one per key outside ``allowed``."""
    source = f"json_keys(event_json, '$.\"{parent}\"')" if parent else "json_keys(event_json)"
    names = ", ".join(f"'{name}'" for name in allowed)
    label = f"'{parent}.' || key" if parent else "key"
    return (
        f"[{label} || ': unknown' FOR key IN {source} IF NOT list_contains([{names}], key)]"
    )


def _user_id() -> str:
    path = '$."user-id"'
    return _check("user-id", f"({_ok(path, 'string', 1, 50)} OR {_ok(path, 'integer', 0)})")


_POSTMATCH_LIMITS = {
    "coin-balance-after-match": ("integer", 0, None),
    "level-after-match": ("integer", 0, None),
    "device": ("string", 1, 200),
    "platform": ("string", 1, 10),
}


def _postmatch_keys(side: str) -> str:
    parent = f"user-{side}-postmatch-info"
    keys = _keys(list(_POSTMATCH_LIMITS), parent)
    return f"CASE WHEN json_type(event_json, '$.\"{parent}\"') = 'OBJECT' THEN {keys} ELSE [] END"


def _postmatch(side: str) -> list[str]:
    parent = f"user-{side}-postmatch-info"
    limits = _POSTMATCH_LIMITS
    is_object = f"json_type(event_json, '$.\"{parent}\"') = 'OBJECT'"
    return [
        _check(parent, is_object, required=side == "a"),
        *(
            _check(name, _ok(f'$."{parent}"."{name}"', *limit), parent=parent)
            for name, limit in limits.items()
        ),
    ]


def _violations() -> str:
    time = _simple("time", "integer", 0)
    checks = {
        "init": [
            time,
            _user_id(),
            _simple("country", "string", 1, 100),
            _simple("platform", "string", 1, 100),
        ],
        "match": [
            time,
            _simple("user-a", "string", 1, 50),
            _simple("user-b", "string", 1, 50),
            *_postmatch("a"),
            *_postmatch("b"),
            _simple("winner", "string", 1, 50),
            _simple("game-tier", "integer", 1, 5),
            _simple("duration", "integer", 0),
        ],
        "in-app-purchase": [
            time,
            _simple("purchase_value", "number", 0),
            _user_id(),
            _simple("product-id", "string", 1, 100),
        ],
    }
    unknown = {
        "init": _keys(list(_INIT)),
        "match": "list_concat("
        + ", ".join([_keys(list(_GAME)), *(_postmatch_keys(side) for side in "ab")])
        + ")",
        "in-app-purchase": _keys(list(_PURCHASE)),
    }
    branches = " ".join(
        f"WHEN kind = '{kind}' THEN array_to_string(list_sort(list_concat({unknown[kind]}, "
        f"[item FOR item IN [{', '.join(items)}] IF item IS NOT NULL])), '; ')"
        for kind, items in checks.items()
    )
    return (
        "CASE WHEN NOT is_object THEN 'payload: not a JSON object' "
        f"{branches} ELSE 'event-type: missing or unknown' END"
    )


_CHECKED = f"""
typed AS (
  SELECT event_id, event_json, is_object,
         CASE WHEN is_object AND json_type(event_json, '$."event-type"') = 'VARCHAR'
              THEN json_extract_string(event_json, '$."event-type"') END AS kind
  FROM (SELECT event_id, is_object,
               CASE WHEN is_object THEN event_json ELSE '{{}}' END AS event_json
        FROM (SELECT *, json_valid(event_json) AS is_object FROM payload))
),
checked AS (SELECT event_id, kind, {_violations()} AS violations FROM typed)
"""

_DAILY = """
SELECT cast(event_ts AS date) AS event_date, country_name, upper(platform) AS platform,
       count(DISTINCT uid) AS distinct_users
FROM init {where} GROUP BY ALL
"""


def _joined(events: str, user: str = "uid") -> str:
    """The left outer interval join, one row per matching init."""
    return f"""
joined AS (
  SELECT e.*, e.{user} AS player, i.country_name AS seen_country
  FROM {events} e LEFT JOIN init i
    ON i.uid = e.{user} AND i.event_ts <= e.event_ts
   AND i.event_ts >= e.event_ts - INTERVAL 24 HOUR
)"""


def _purchases(width: int) -> str:
    return f"""
SELECT {_window("sec", width)} AS window_start,
       {_window("sec", width)} + INTERVAL {width} SECOND AS window_end,
       count(*) AS purchase_count, round(sum(value), 2) AS total_revenue,
       count(DISTINCT uid) AS distinct_users
FROM purchase GROUP BY ALL"""


def _matches(width: int) -> str:
    return f"""
SELECT {_window("sec", width)} AS window_start,
       {_window("sec", width)} + INTERVAL {width} SECOND AS window_end,
       count(*) AS match_count, count(DISTINCT uid) AS distinct_users_a,
       count(DISTINCT uid_b) AS distinct_users_b
FROM game GROUP BY ALL"""


def _by_country(width: int, metrics: str, source: str = "joined") -> str:
    return f"""
SELECT {_window("sec", width)} AS window_start,
       {_window("sec", width)} + INTERVAL {width} SECOND AS window_end,
       seen_country AS country_name, {metrics}, count(DISTINCT player) AS distinct_users
FROM {source} GROUP BY ALL"""


_REVENUE = "round(sum(value), 2) AS country_revenue, count(*) AS purchase_count"
_MATCHES = "count(*) AS match_count"
_BY_PRODUCT = f"""
SELECT {_window("sec", 60)} AS window_start,
       {_window("sec", 60)} + INTERVAL 1 MINUTE AS window_end,
       product_name, count(*) AS purchase_count, round(sum(value), 2) AS product_revenue
FROM purchase GROUP BY ALL"""

_SLIDING = f"""
SELECT make_timestamp((sec // 60 - back) * 60 * 1000000) AS window_start,
       make_timestamp((sec // 60 - back + 5) * 60 * 1000000) AS window_end,
       seen_country AS country_name, {_REVENUE}, count(DISTINCT player) AS distinct_users
FROM joined, (SELECT unnest([0, 1, 2, 3, 4]) AS back) GROUP BY ALL"""


def _closed(body: str, *inputs: str, extra: str = "") -> str:
    """Windows an append-mode stream has emitted once it has read everything."""
    latest = ", ".join(f"(SELECT max(event_ts) FROM {name})" for name in inputs)
    return f"""
SELECT * FROM ({body})
WHERE window_end <= least({latest}) - INTERVAL 10 MINUTE {extra}"""


_LATE = f"""
arrivals AS (
  SELECT *, least(part + CASE WHEN product_name = 'Unknown Product' THEN 1 ELSE 0 END, 2) AS arrival
  FROM (SELECT *, CASE WHEN event_ts < '{LATE_BOUNDS[0]}' THEN 0
                       WHEN event_ts < '{LATE_BOUNDS[1]}' THEN 1 ELSE 2 END AS part
        FROM purchase)
),
kept AS (
  SELECT a.* FROM arrivals a
  WHERE coalesce({_window("a.sec", 60)} + INTERVAL 1 MINUTE >
        (SELECT max(b.event_ts) FROM arrivals b WHERE b.arrival < a.arrival)
        - INTERVAL 10 MINUTE, true)
)"""
_LATE_BODY = f"""
SELECT * FROM (
  SELECT {_window("sec", 60)} AS window_start,
         {_window("sec", 60)} + INTERVAL 1 MINUTE AS window_end,
         count(*) AS purchase_count, round(sum(value), 2) AS total_revenue,
         count(DISTINCT uid) AS distinct_users
  FROM kept GROUP BY ALL)
WHERE window_end <= (SELECT max(event_ts) FROM purchase) - INTERVAL 10 MINUTE"""


def _few(fallback: str) -> str:
    return (
        "CASE country WHEN 'US' THEN 'United States' WHEN 'UK' THEN 'United Kingdom' "
        f"WHEN 'BR' THEN 'Brazil' ELSE {fallback} END"
    )


def _on_inits(columns: str) -> str:
    return _with(f'SELECT ms AS "time", uid AS "user-id", {columns} FROM init')


def _count_by(column: str, table: str) -> str:
    return f"SELECT {column}, count(*) AS count FROM {table} GROUP BY ALL"


def _top(body: str, order: str, n: int) -> str:
    return f"SELECT * FROM ({body}) ORDER BY {order} LIMIT {n}"


def _enriched(columns: str) -> str:
    return (
        f'SELECT ms AS "time", {columns}, event_ts AS event_timestamp, '
        "seen_country AS country_name FROM latest"
    )


_BUYER = 'uid AS "user-id", product AS "product-id", value AS purchase_value'
_PLAYERS = 'uid AS "user-a", uid_b AS "user-b", ' + _GAME["winner"] + " AS winner"

_BRONZE = """
SELECT event_json, ts AS kafka_timestamp, topic AS kafka_topic,
       cast(event_id % 3 AS integer) AS kafka_partition, event_id AS kafka_offset
FROM payload"""


def _layer_counts() -> str:
    tables = {
        "bronze": "feed",
        "silver-init": "init",
        "silver-match": "game",
        "silver-purchase": "purchase",
        "gold-daily-users": f"({_DAILY.format(where='')})",
        "gold-minute-purchases": f"({_purchases(60)})",
        "gold-minute-matches": f"({_matches(60)})",
        "gold-minute-purchases-by-country": f"({_by_country(60, _REVENUE)})",
        "gold-minute-matches-by-country": f"({_by_country(60, _MATCHES, 'joined_games')})",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {source}"
        for name, source in tables.items()
    )


_CLEAN, _FAULTY = _payload(False), _payload(True)
_BUYERS, _GAMES = _joined("purchase"), _joined("game")
_BOTH = """
joined AS (
  SELECT p.*, i.country_name AS seen_country
  FROM (SELECT *, uid AS player FROM game UNION ALL SELECT *, uid_b FROM game) p
  LEFT JOIN init i
    ON i.uid = p.player AND i.event_ts <= p.event_ts
   AND i.event_ts >= p.event_ts - INTERVAL 24 HOUR
)"""
_LATEST = """
latest AS (
  SELECT * FROM (
    SELECT e.*, i.country_name AS seen_country,
           row_number() OVER (PARTITION BY e.event_id
                              ORDER BY i.ms DESC NULLS LAST, i.country_name DESC) AS rank
    FROM purchase e LEFT JOIN init i
      ON i.uid = e.uid AND i.event_ts <= e.event_ts
     AND i.event_ts >= e.event_ts - INTERVAL 24 HOUR)
  WHERE rank = 1
)"""
_GAMES_TOO = _GAMES.replace("joined AS", "joined_games AS")
_TOP_COUNTRIES_REVENUE = """
SELECT seen_country AS country_name, round(sum(value), 2) AS total_revenue,
       count(*) AS total_purchases
FROM joined GROUP BY ALL"""
_TOP_COUNTRIES_MATCHES = """
SELECT seen_country AS country_name, count(*) AS total_matches FROM joined GROUP BY ALL"""
_LOOK_BACK = "- INTERVAL 24 HOUR"


def _counted(columns: str) -> str:
    """One row per event and country, with the number of matching inits, at least 1."""
    return f"""
SELECT * EXCLUDE (event_id) FROM (
  SELECT event_id, ms AS "time", {columns}, event_ts AS event_timestamp,
         seen_country AS country_name, count(*) AS copies
  FROM joined GROUP BY ALL)"""


ORACLE: dict[str, str] = {
    "bronze_projection": _with(_BRONZE, _CLEAN),
    "bronze_projection_legacy": _with(
        """
SELECT uid AS kafka_key, event_json AS value, topic,
       cast(event_id % 3 AS integer) AS "partition", event_id AS "offset", ts AS kafka_timestamp
FROM payload""",
        _CLEAN,
    ),
    "parse_events": _with(_PARSED),
    "drop_unparseable": _with(
        "SELECT event_id AS kafka_offset, event_json FROM payload WHERE json_valid(event_json)",
        _CLEAN,
    ),
    "event_time": _with(
        """
SELECT CASE WHEN ok THEN ms END AS "time", CASE WHEN ok THEN event_ts END AS event_timestamp,
       CASE WHEN ok THEN cast(event_ts AS date) END AS event_date
FROM (SELECT *, event_type <> 'error' AS ok FROM feed)"""
    ),
    "evolved_read": _with(
        f"""
SELECT event_id AS kafka_offset, topic AS kafka_topic, ts AS kafka_timestamp,
       CASE WHEN ts >= '{DAY}' THEN 'game' END AS source_system
FROM feed"""
    ),
    "validate_events": _with(
        """
SELECT event_id AS kafka_offset, kind AS event_type, violations = '' AS is_valid, violations
FROM checked""",
        _FAULTY,
        _CHECKED,
    ),
    "valid_events": _with(
        _BRONZE + " WHERE event_id IN (SELECT event_id FROM checked WHERE violations = '')",
        _FAULTY,
        _CHECKED,
    ),
    "validation_summary": _with(
        """
SELECT kind AS event_type, count(*) AS generated,
       count(*) FILTER (violations = '') AS valid, count(*) FILTER (violations <> '') AS invalid
FROM checked GROUP BY ALL""",
        _FAULTY,
        _CHECKED,
    ),
    "route_topics": _with(
        "SELECT topic, event_json AS value FROM payload WHERE event_type <> 'error'", _CLEAN
    ),
    "silver_init": _with(_silver("init")),
    "silver_match": _with(_silver("match")),
    "silver_purchase": _with(_silver("purchase")),
    "flatten_match": _with(f'SELECT ms AS "time", uid AS "user-a", {_list(_FLAT)} FROM game'),
    "rule_uppercase": _on_inits("upper(platform) AS platform"),
    "rule_lowercase": _on_inits("lower(platform) AS platform_key"),
    "rule_trim": _on_inits("'  ' || platform || ' ' AS padded, platform AS trimmed"),
    "rule_custom": _on_inits("uid[6:] AS user_number"),
    "rule_mapping_default": _on_inits(f"{_few(repr('Other'))} AS country_name"),
    "rule_mapping_null": _on_inits(
        f"{_few('NULL')} AS country_name, {_few('NULL')} AS country_literal"
    ),
    "rule_mapping_passthrough": _on_inits(f"{_few('country')} AS country"),
    "silver_to_json": _with(_silver_json()),
    "daily_users": _with(_DAILY.format(where="")),
    "daily_users_date": _with(_DAILY.format(where=f"WHERE cast(event_ts AS date) = '{DAY}'")),
    "daily_users_range": _with(
        _DAILY.format(
            where=f"WHERE cast(event_ts AS date) BETWEEN '{RANGE[0]}' AND '{RANGE[1]}'"
        )
    ),
    "daily_users_by_country": _with(
        """
SELECT cast(event_ts AS date) AS event_date, country_name, count(DISTINCT uid) AS distinct_users
FROM init GROUP BY ALL"""
    ),
    "rollup_users_daily": _with(_DAILY.format(where="")),
    "rollup_users_by_country": _with(
        """
SELECT cast(event_ts AS date) AS event_date, country_name, count(DISTINCT uid) AS distinct_users
FROM init GROUP BY ALL"""
    ),
    "rollup_users_range": _with(
        _DAILY.format(
            where=f"WHERE cast(event_ts AS date) BETWEEN '{RANGE[0]}' AND '{RANGE[1]}'"
        )
    ),
    "rollup_users_of_range": _with(
        f"""
SELECT country_name, count(DISTINCT uid) AS distinct_users
FROM init WHERE cast(event_ts AS date) BETWEEN '{RANGE[0]}' AND '{RANGE[1]}' GROUP BY ALL"""
    ),
    "daily_users_write": _with(
        f"""
SELECT * FROM ({_DAILY.format(where="")})
UNION ALL SELECT * FROM ({_DAILY.format(where="")}) WHERE event_date = '{DAY}'"""
    ),
    "daily_users_overwrite": _with(_DAILY.format(where="")),
    "daily_rows_per_date": _with(
        f"SELECT event_date, count(*) AS records FROM ({_DAILY.format(where='')}) GROUP BY ALL"
    ),
    "daily_users_ranked": _with(_DAILY.format(where=f"WHERE cast(event_ts AS date) = '{DAY}'")),
    "init_rows_per_date": _with(
        """
SELECT cast(event_ts AS date) AS event_date, count(*) AS records FROM init GROUP BY ALL
ORDER BY event_date DESC LIMIT 10"""
    ),
    "enrich_purchases": _with(_counted(_BUYER), _BUYERS),
    "enrich_matches": _with(_counted(_PLAYERS), _GAMES),
    "enrich_purchases_latest": _with(_enriched(_BUYER), _LATEST),
    "minute_purchases": _with(_purchases(60)),
    "hourly_purchases": _with(_purchases(3600)),
    "minute_matches": _with(_matches(60)),
    "hourly_matches": _with(_matches(3600)),
    "minute_purchases_by_country": _with(_by_country(60, _REVENUE), _BUYERS),
    "hourly_purchases_by_country": _with(_by_country(3600, _REVENUE), _BUYERS),
    "minute_matches_by_country": _with(_by_country(60, _MATCHES), _GAMES),
    "hourly_matches_by_country": _with(_by_country(3600, _MATCHES), _GAMES),
    "sliding_purchases_by_country": _with(_SLIDING, _BUYERS),
    "minute_matches_by_country_both": _with(_by_country(60, _MATCHES), _BOTH),
    "minute_revenue_by_product": _with(_BY_PRODUCT),
    "minute_match_players": _with(
        f"""
SELECT {_window("sec", 60)} AS window_start,
       {_window("sec", 60)} + INTERVAL 1 MINUTE AS window_end,
       count(DISTINCT player) AS distinct_users
FROM (SELECT sec, uid AS player FROM game UNION ALL SELECT sec, uid_b FROM game) GROUP BY ALL"""
    ),
    "minute_purchases_since": _with(
        f"""
SELECT * FROM ({_purchases(60)}) WHERE window_start >= TIMESTAMP '{SINCE}'
ORDER BY window_start DESC LIMIT 10"""
    ),
    "layer_counts": _with(_layer_counts(), _BUYERS, _GAMES_TOO),
    "report_bronze_by_topic": _with(_count_by("topic AS kafka_topic", "feed")),
    "report_init_by_platform": _with(_count_by("upper(platform) AS platform", "init")),
    "report_init_by_country": _with(
        _top(_count_by("country_name", "init"), "count DESC, country_name", 10)
    ),
    "report_match_by_platform": _with(
        _count_by("upper(played_on) AS user_a_platform", "game")
    ),
    "report_total_revenue": _with(
        "SELECT round(coalesce(sum(value), 0), 2) AS total_revenue FROM purchase"
    ),
    "report_revenue_by_product": _with(
        _top(
            """
SELECT product_name, count(*) AS count, round(sum(value), 2) AS revenue
FROM purchase GROUP BY ALL""",
            "revenue DESC, product_name",
            10,
        )
    ),
    "report_daily_users": _with(
        _top(_DAILY.format(where=""), "event_date, country_name, platform", 20)
    ),
    "report_minute_purchases": _with(_top(_purchases(60), "window_start", 20)),
    "report_minute_matches": _with(_top(_matches(60), "window_start", 20)),
    "report_top_countries_revenue": _with(
        _top(_TOP_COUNTRIES_REVENUE, "total_revenue DESC, country_name", 10), _BUYERS
    ),
    "report_top_countries_matches": _with(
        _top(_TOP_COUNTRIES_MATCHES, "total_matches DESC, country_name", 10), _GAMES
    ),
    "report_purchases_country": _with(
        _top(_by_country(60, _REVENUE), "window_start, country_name NULLS FIRST", 20), _BUYERS
    ),
    "report_matches_country": _with(
        _top(_by_country(60, _MATCHES), "window_start, country_name NULLS FIRST", 20), _GAMES
    ),
    "report_platform_country": _with(
        _count_by("upper(platform) AS platform, country_name", "init")
    ),
    "report_top_users": _with(
        _top(_count_by('uid AS "user-id"', "init"), 'count DESC, "user-id"', 10)
    ),
    "report_hourly_activity": _with(
        f"""
SELECT {_window("sec", 3600)} AS window_start,
       {_window("sec", 3600)} + INTERVAL 1 HOUR AS window_end, count(*) AS count
FROM init GROUP BY ALL"""
    ),
    "sample_bronze": _with(
        "SELECT topic AS kafka_topic, ts AS kafka_timestamp FROM feed ORDER BY event_id LIMIT 10"
    ),
    "sample_init": _with(
        """
SELECT uid AS "user-id", upper(platform) AS platform, country, country_name
FROM init ORDER BY ms, uid LIMIT 10"""
    ),
    "sample_match": _with(
        f"""
SELECT {_PLAYERS}, {_list(_PLATFORMS)}, cast(k % 5 + 1 AS integer) AS "game-tier"
FROM game ORDER BY ms, uid LIMIT 10"""
    ),
    "sample_purchase": _with(
        f"SELECT {_BUYER}, product_name FROM purchase ORDER BY ms, uid LIMIT 10"
    ),
    "bronze_ingest": _with(_BRONZE, _CLEAN),
    "silver_init_stream": _with(_silver("init")),
    "silver_match_stream": _with(_silver("match")),
    "silver_purchase_stream": _with(_silver("purchase")),
    "silver_fan_out_stream": _with(
        """
SELECT 'silver-init' AS "table", count(*) AS rows FROM init
UNION ALL SELECT 'silver-match', count(*) FROM game
UNION ALL SELECT 'silver-purchase', count(*) FROM purchase"""
    ),
    "minute_purchases_stream": _with(_closed(_purchases(60), "purchase")),
    "minute_matches_stream": _with(
        _closed(_matches(60), "game")
    ),
    "minute_revenue_by_product_stream": _with(
        f"""
SELECT * FROM ({_BY_PRODUCT})
WHERE window_end <= (SELECT max(event_ts) FROM purchase) - INTERVAL 10 MINUTE"""
    ),
    "minute_purchases_by_country_stream": _with(
        _closed(_by_country(60, _REVENUE), "purchase", "init", extra=_LOOK_BACK),
        _BUYERS,
    ),
    "minute_matches_by_country_stream": _with(
        _closed(_by_country(60, _MATCHES), "game", "init", extra=_LOOK_BACK),
        _GAMES,
    ),
    "state_after_eviction": _with(
        """
SELECT uid AS "user", country_name, cast(epoch(event_ts) AS bigint) AS second, count(*) AS copies
FROM init, (
  SELECT least((SELECT max(event_ts) FROM init), (SELECT max(event_ts) FROM purchase)) - INTERVAL 10 MINUTE AS mark
)
WHERE event_ts >= mark - INTERVAL 24 HOUR AND event_ts + INTERVAL 1 SECOND <= mark
GROUP BY ALL"""
    ),
    "late_data_stream": _with(_LATE_BODY, _LATE),
    "stream_progress": _with(
        """
SELECT cast(count(*) AS bigint) AS input_rows, cast(0 AS bigint) AS late_rows,
       true AS has_batches
FROM purchase"""
    ),
    "silver_fan_out_init": _with(_silver("init")),
    "compacted_days": _with(_silver("init")),
    "silver_fan_out_match": _with(_silver("match")),
    "silver_fan_out_purchase": _with(_silver("purchase")),
    "publish_valid_stream": _with(
        """
SELECT topic, event_json AS value FROM payload
WHERE event_id IN (SELECT event_id FROM checked WHERE violations = '')""",
        _FAULTY,
        _CHECKED,
    ),
    "daily_job": _with(
        _DAILY.format(
            where=f"WHERE cast(event_ts AS date) BETWEEN '{RANGE[0]}' AND '{RANGE[1]}'"
        )
    ),
    "rule_mapping_large": _on_inits(
        "CASE WHEN user_id < 20000 THEN cast(user_id * 7 AS integer) END AS points"
    ),
}
