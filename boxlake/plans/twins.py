"""SQL twins of the registered queries, for DuckDB on the same tables.

They start from the same derived rows and state the expected result of each operator
on their own, case by case.
"""

from __future__ import annotations

from boxlake.schemas import LINEUP_KEY, TEAM_RATINGS, TEAM_STATS
from boxlake.sources import adapted as A


# Expected texts, written out: a changed text in the code must not change its twin.
REQUIRED_TEXTS = {
    "game_id": "Game ID is required",
    "team_id": "Team ID is required",
    "player_id": "Player ID is required",
    "home_team_id": "Home team ID is required",
    "away_team_id": "Away team ID is required",
    "game_date": "Game date is required",
}
GAME_ID_LENGTH_TEXT = "Game ID must be exactly 10 characters"
SAME_TEAMS_TEXT = "Home and away team IDs must be different"
SEASON_TEXT = "Season must be in format YYYY-YY (e.g., 2024-25)"
SHOTS = (("field_goals", "fgm", "fga"), ("three_pointers", "fg3m", "fg3a"), ("free_throws", "ftm", "fta"))
SHOT_TEXTS = {
    "field_goals": "Field goals made cannot exceed attempts",
    "three_pointers": "Three pointers made cannot exceed attempts",
    "free_throws": "Free throws made cannot exceed attempts",
}
POINTS_TEXT = "Points cannot be negative"
REBOUNDS_TEXT = "Total rebounds significantly differs from oreb + dreb"
THREES_MADE_TEXT = "Three pointers made cannot exceed total field goals made"
THREES_TRIED_TEXT = "Three pointers attempted cannot exceed total field goals attempted"
NEVER_NEGATIVE = ("pts", "reb", "ast", "stl", "blk", "pf")
NEGATIVE_TEXT = "{} cannot be negative"
# Of the reasons only those that games of the queries have.
REASONS = {
    "malformed_payload": "landed document is not a JSON object",
    "no_summary": "no summary object in the document",
    "missing_team_ids": "home or away team id missing or unreadable",
    "missing_game_time": "neither a UTC nor a local game time",
    "unreadable_time": "game date or time cannot be read",
    "out_of_range": "a number does not fit its column or a text is too long",
}


def _columns(expressions: dict[str, str]) -> str:
    return ", ".join(A.columns_sql(expressions))


COMMON = {
    "games": f"SELECT {_columns(A.GAMES)} FROM orders",
    "dirty": f"SELECT {_columns(A.DIRTY_GAMES)} FROM orders",
    "completed": """SELECT game_id, season, game_key FROM games
        WHERE game_key % 17 <> 0 AND game_key % 19 <> 0 AND game_status IN ('F', 'O')""",
    "sides": f"""SELECT l_orderkey AS game_key, l_suppkey % 2 AS side, {_columns(A.SIDE_STATS)}
        FROM lineitem GROUP BY 1, 2""",
    "tbox": """SELECT game_key, side, game_id, season, game_date,
        CASE WHEN side = 0 THEN home_team_id ELSE away_team_id END AS team_id, side = 0 AS is_home,
        CASE WHEN side = 0 THEN away_team_id ELSE home_team_id END AS opponent_team_id, '240' AS minutes,
        """ + ", ".join(A.SIDE_STATS) + """,
        CAST(pts + 100 AS DOUBLE) AS off_rating, CAST(fga + 90 AS DOUBLE) AS def_rating,
        CAST(pts - fga + 10 AS DOUBLE) AS net_rating, CAST(tov * 10 AS DOUBLE) AS pace,
        CAST(0.5 AS DOUBLE) AS ts_pct
        FROM sides JOIN games USING (game_key)""",
    "scored": """SELECT b.*, o.pts AS opponent_pts, CAST(b.pts > o.pts AS INT) AS win FROM tbox b
        LEFT JOIN tbox o ON o.game_id = b.game_id AND o.team_id = b.opponent_team_id""",
    "pbox": f"""SELECT game_key, game_id, season, game_date, home_team_id, away_team_id,
        {_columns(A.PLAYER_ENTRIES)}, {_columns(A.ENTRY_ORDER)}
        FROM lineitem JOIN games ON l_orderkey = game_key""",
    "dtbox": f"SELECT * REPLACE ({_columns(A.DIRTY_TEAMBOX)}) FROM tbox",
    "dpbox": f"SELECT * REPLACE ({_columns(A.DIRTY_PLAYERBOX)}) FROM pbox",
    "errs": """SELECT event_id AS id, 'load_' || (user_id % 4) AS process_name,
        CASE WHEN user_id % 10 <> 0 THEN lpad(CAST(event_id - event_id % 3 AS VARCHAR), 10, '0') END AS game_id,
        CASE k % 3 WHEN 0 THEN 'ReadTimeout' WHEN 1 THEN 'ConnectionError' ELSE 'ValueError' END AS error_type,
        'event ' || event_id AS error_message, k % 5 = 0 AS is_resolved, ts AS created_at
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE event_type = 'error')""",
    "recent_errs": "SELECT * FROM errs WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY",
    # The outcome of each landed document kind.
    "summaries": """SELECT *, CASE WHEN game_key % 8 = 0 AND game_key % 23 = 0 THEN 'out_of_range' ELSE CASE game_key % 8 WHEN 1 THEN 'no_summary' WHEN 3 THEN 'missing_team_ids'
        WHEN 4 THEN 'missing_game_time' WHEN 5 THEN 'unreadable_time' WHEN 7 THEN 'malformed_payload' END END
        AS reject_reason FROM games""",
    "dims": f"""SELECT game_id, pos,
        CASE WHEN none OR w <> 2 THEN tid ELSE tid + 100 END AS team_id,
        CASE WHEN none THEN NULL WHEN w = 3 THEN 'A' || n ELSE 'T' || n END AS abbreviation,
        CASE WHEN none THEN NULL WHEN w < 3 THEN 'Name' || n ELSE 'Nick' || n END AS team_name,
        CASE WHEN none OR w = 4 THEN NULL ELSE 'City' || n END AS city,
        CASE WHEN none OR w = 4 THEN NULL WHEN w < 3 THEN 'Name' || n
             ELSE 'City' || n || ' Nick' || n END AS full_name
        FROM (SELECT game_id, pos, game_key % 5 AS w, pos = 0 AND game_key % 8 = 6 AS none,
                     tid, tid - {A.FIRST_TEAM} AS n
              FROM (SELECT game_id, game_key, CAST(0 AS INT) AS pos, home_team_id AS tid FROM summaries
                    WHERE reject_reason IS NULL
                    UNION ALL SELECT game_id, game_key, CAST(1 AS INT), away_team_id FROM summaries
                    WHERE reject_reason IS NULL))""",
    # s: which statistics object a team gets, NULL for none.
    "boxdocs": """SELECT *, CASE WHEN game_key % 11 = 0 THEN 'not_landed'
        WHEN game_key % 8 = 7 THEN 'malformed_payload'
        WHEN game_key % 8 = 0 AND game_key % 23 = 0 THEN 'out_of_range' END AS reject_reason FROM games""",
    "boxsides": """
        SELECT *, CAST(0 AS INT) AS pos, home_team_id AS team_id, true AS is_home, away_team_id AS opponent_team_id,
            CASE WHEN game_key % 8 = 4 THEN 2 WHEN game_key % 8 <= 3 AND home_team_id = away_team_id THEN 1 ELSE 0 END AS s
        FROM boxdocs WHERE reject_reason IS NULL
        UNION ALL
        SELECT *, CAST(1 AS INT), away_team_id, false, home_team_id,
            CASE WHEN game_key % 8 <= 3 THEN 1
                 WHEN game_key % 8 = 4 THEN CASE WHEN home_team_id = away_team_id THEN 2 ELSE 1 END
                 WHEN home_team_id = away_team_id THEN 0 END
        FROM boxdocs WHERE reject_reason IS NULL""",
    "boxrows": """SELECT game_id, season, pos, team_id, is_home, opponent_team_id, s,
        CASE WHEN s IS NULL THEN NULL WHEN game_key % 3 = 0 THEN '240' WHEN game_key % 3 = 1 THEN '240:00' END AS minutes,
        CAST(CASE WHEN p <> 0 THEN p WHEN p = 0 AND game_key % 2 = 0 THEN 50 END AS INT) AS pts,
        CAST(p AS INT) AS kept_pts,
        CAST(m AS INT) AS fgm, CAST(m + 10 AS INT) AS fga, CAST(m AS INT) AS ast,
        CAST(CASE WHEN game_key % 4 <> 0 THEN m + 1 END AS INT) AS stl, CAST(NULL AS INT) AS tov,
        CASE WHEN r <> 0 THEN CAST(r AS DOUBLE) WHEN r = 0 AND game_key % 2 = 0 THEN 100.5::DOUBLE END AS off_rating,
        CAST(r AS DOUBLE) AS kept_off_rating, CAST(r AS DOUBLE) AS net_rating,
        CASE WHEN game_key % 3 = 0 THEN CAST(r AS DOUBLE) ELSE CAST('9' || CAST(r AS VARCHAR) || '.25' AS DOUBLE) END AS pace,
        CASE WHEN s IS NOT NULL THEN 0.625::DOUBLE END AS ts_pct
        FROM (SELECT *, (cust + s) % 7 AS p, (game_key + s) % 5 AS m, (cust + s) % 4 AS r FROM boxsides)""",
    "playerdocs": """SELECT *, CASE WHEN game_key % 13 = 0 THEN 'not_landed'
        WHEN game_key % 8 = 0 AND game_key % 23 = 0 THEN 'out_of_range' ELSE CASE game_key % 8
        WHEN 1 THEN 'no_player_table' WHEN 2 THEN 'no_player_table' WHEN 5 THEN 'missing_player_columns'
        WHEN 6 THEN 'no_player_rows' WHEN 7 THEN 'malformed_payload' END END AS reject_reason FROM games""",
    "listed": """SELECT *, (cust * 3 + i * i) % 450 + 1 AS p,
        CASE WHEN i % 5 = 4 THEN 1 WHEN i % 2 = 0 THEN home_team_id ELSE away_team_id END AS t
        FROM (SELECT *, unnest(range(0, 3 + game_key % 4)) AS i FROM playerdocs WHERE reject_reason IS NULL)
        WHERE NOT (game_key % 8 = 4 AND i = 1)""",
}


def _with(names: str, body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({COMMON[n]})" for n in names.split()) + "\n" + body


def _rule(field: str, value: str, rule: str, message: str, broken: str) -> tuple[str, ...]:
    return field, value, rule, message, broken


def _violations(source: str, keep: str, rules: list[tuple[str, ...]]) -> str:
    def quote(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    head = f"{keep}, " if keep else ""
    parts = [
        f"""SELECT {head}{quote(field)} AS field, CAST({value} AS VARCHAR) AS value, {quote(rule)} AS rule,
        {quote(message)} AS message FROM {source} WHERE {broken}"""
        for field, value, rule, message, broken in rules
    ]
    return (
        "SELECT *, field || ': ' || message || ' (value=' || coalesce(value, 'None') || ', rule=' || rule || ')' AS text"
        " FROM (" + "\nUNION ALL ".join(parts) + ")"
    )


def _required(name: str, text: bool = False) -> tuple[str, ...]:
    empty = f"{name} IS NULL" if name == "game_date" else f"{name} = ''" if text else f"{name} = 0"
    return _rule(name, name, "required", REQUIRED_TEXTS[name], f"{name} IS NULL OR {empty}")


def _zero(name: str) -> str:
    return f"coalesce({name}, 0)"


_SHOT_RULES = [
    _rule(field, f"'made=' || {_zero(m)} || ', attempted=' || {_zero(a)}", "logic_check", SHOT_TEXTS[field],
          f"{_zero(m)} > {_zero(a)}")
    for field, m, a in SHOTS
]


def _season_ok(low: int, high: int) -> str:
    matches = "regexp_full_match(season, '\\d{4}-\\d{2}')"
    return (
        f"coalesce(CASE WHEN {matches} THEN CAST(left(season, 4) AS INT) BETWEEN {low} AND {high}"
        f" AND CAST(right(season, 2) AS INT) = (CAST(left(season, 4) AS INT) + 1) % 100 ELSE false END, false)"
    )


GAME_RULES = [
    _required("game_id", text=True),
    _rule("game_id", "game_id", "length_check", GAME_ID_LENGTH_TEXT, "game_id <> '' AND length(game_id) <> 10"),
    _required("home_team_id"),
    _required("away_team_id"),
    _rule("team_ids", "'home=' || home_team_id || ', away=' || away_team_id", "uniqueness", SAME_TEAMS_TEXT,
          "home_team_id <> 0 AND away_team_id <> 0 AND home_team_id = away_team_id"),
    _required("game_date"),
    _rule("season", "season", "format_check", SEASON_TEXT, f"season <> '' AND NOT {_season_ok(1000, 9999)}"),
]
TEAMBOX_RULES = [
    _required("game_id", text=True),
    _required("team_id"),
    *_SHOT_RULES,
    _rule("pts", "pts", "range_check", POINTS_TEXT, "pts < 0"),
    _rule("rebounds", "'total=' || reb || ', oreb=' || oreb || ', dreb=' || dreb", "consistency_check", REBOUNDS_TEXT,
          "reb > 0 AND abs(reb - (oreb + dreb)) > 5"),
]
PLAYERBOX_RULES = [
    _required("game_id", text=True),
    _required("player_id"),
    _required("team_id"),
    *_SHOT_RULES,
    _rule("shooting", "'fg3m=' || fg3m || ', fgm=' || fgm", "logic_check", THREES_MADE_TEXT, "fg3m > fgm"),
    _rule("shooting", "'fg3a=' || fg3a || ', fga=' || fga", "logic_check", THREES_TRIED_TEXT, "fg3a > fga"),
    *[_rule(s, s, "range_check", NEGATIVE_TEXT.format(s.upper()), f"{s} < 0") for s in NEVER_NEGATIVE],
]

_REASON_TEXT = "CASE reject_reason " + " ".join(f"WHEN '{r}' THEN '{t}'" for r, t in REASONS.items()) + " END"
_ENTRY_KEYS = ", ".join(A.ENTRY_ORDER)
_ENTRY_LAST = ", ".join(f"{c} DESC" for c in A.ENTRY_ORDER)
_ACTION = "CASE WHEN n.{k} IS NULL THEN 'kept' WHEN o.{k} IS NULL THEN 'inserted' ELSE 'updated' END AS merge_action"


def _keep_or_new(columns, mark: str) -> str:
    return ", ".join(f"CASE WHEN n.{mark} IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in columns)


def _new_or_old(columns) -> str:
    return ", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in columns)


_MISSING_TEAMBOX = """FROM games g WHERE NOT EXISTS
    (SELECT 1 FROM lineitem l WHERE l.l_orderkey = g.game_key AND l.l_orderkey % 5 <> 0)"""
_TEAMBOX_SHOWN = "minutes, pts, fgm, fga, ast, stl, tov, off_rating, net_rating, pace, ts_pct"

_ORPHANS = """
    SELECT DISTINCT game_id, 'game_id' AS reference FROM pbox WHERE game_key % 7 = 0
    UNION ALL
    SELECT DISTINCT game_id, 'player_id' FROM pbox WHERE player_id NOT IN
        (SELECT 1 + p_partkey % 450 FROM part WHERE p_partkey % 450 <> 7)
    UNION ALL
    SELECT DISTINCT game_id, 'team_id' FROM pbox WHERE team_id NOT IN
        (SELECT home_team_id FROM games WHERE game_key % 7 <> 0
         UNION SELECT away_team_id FROM games WHERE game_key % 7 <> 0)"""

_SEASON_TEXTS = """SELECT o_orderkey, CASE o_orderkey % 7
        WHEN 0 THEN four || '-' || (y + 1) WHEN 1 THEN right(four, 2) || '-' || yy
        WHEN 2 THEN four || '-' || right(four, 2) WHEN 3 THEN '' WHEN 5 THEN four || '-x' || left(yy, 1)
        WHEN 6 THEN NULL ELSE four || '-' || yy END AS season
    FROM (SELECT o_orderkey, y, lpad(CAST(y AS VARCHAR), 4, '0') AS four,
                 lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS yy
          FROM (SELECT o_orderkey, o_orderkey % 9000 AS y FROM orders))"""

_OPERAND = """CASE {i} WHEN 0 THEN o_custkey WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 5 THEN 0 END"""
_TRUTHY = "(({i} = 0 AND o_custkey <> 0) OR {i} = 3 OR {i} = 9)"


def _operand(i: str) -> str:
    return _OPERAND.format(i=i)


def _truthy(i: str) -> str:
    return _TRUTHY.format(i=i)


def _row_text(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)


TWINS = {
    "spine_extract": _with("games completed", "SELECT DISTINCT game_id, season FROM completed"),
    "spine_insert_ignore": _with("games completed", """
        SELECT game_id, '1900-01' AS season, 'kept' AS merge_action FROM games WHERE game_key % 7 <> 0
        UNION ALL SELECT game_id, season, 'inserted' FROM completed WHERE game_key % 7 = 0"""),
    "spine_counts": _with("games completed", """SELECT season, count(*) AS attempted,
        count(*) FILTER (game_key % 7 = 0) AS inserted FROM completed GROUP BY season"""),
    "spine_from_ids": _with("games", """SELECT game_id, season FROM games
        UNION ALL SELECT 'x' || game_id, season FROM games"""),
    "missing_games": _with("games completed", "SELECT game_id, season FROM completed WHERE game_key % 7 = 0"),
    "missing_teambox": _with("games", f"""SELECT game_id, season, CAST(game_date AS VARCHAR) AS game_date,
        home_team_id, away_team_id {_MISSING_TEAMBOX}"""),
    "missing_playerbox": _with("games", """SELECT game_id, season, CAST(game_date AS VARCHAR) AS game_date,
        home_team_id, away_team_id FROM games WHERE game_key NOT IN (SELECT l_orderkey FROM lineitem)"""),
    "worklist_first_n": _with("games", f"""SELECT game_id, season, CAST(game_date AS VARCHAR) AS game_date
        {_MISSING_TEAMBOX}
        QUALIFY row_number() OVER (PARTITION BY season ORDER BY g.game_date, game_id) <= 50"""),
    "worklist_one_season": _with("games completed", """SELECT game_id, season FROM completed
        WHERE game_key % 7 = 0 AND season = '1997-98' ORDER BY game_id LIMIT 50"""),
    "parse_int": """SELECT o_orderkey, CASE o_orderkey % 14 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey
        WHEN 2 THEN o_custkey WHEN 9 THEN 1 WHEN 10 THEN o_custkey WHEN 11 THEN -o_custkey WHEN 12 THEN 1000
        WHEN 13 THEN -o_custkey END AS parsed FROM orders""",
    "parse_float": """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 14 IN (0, 1, 10) THEN c
        WHEN o_orderkey % 14 IN (2, 3) THEN c || '.7' WHEN o_orderkey % 14 = 9 THEN '1'
        WHEN o_orderkey % 14 = 11 THEN '-' || c || '.7' WHEN o_orderkey % 14 = 12 THEN '1000'
        WHEN o_orderkey % 14 = 13 THEN '-' || c END AS DOUBLE) AS parsed
        FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c FROM orders)""",
    "parse_bool": """SELECT o_orderkey, CASE
        WHEN o_orderkey % 26 IN (0, 2, 3, 4, 5, 6, 7, 14, 15, 16, 17, 24) THEN true
        WHEN o_orderkey % 26 IN (20, 21, 22, 23) THEN NULL ELSE false END AS parsed FROM orders""",
    "parse_string": """SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 'ball'
        WHEN 1 THEN 'Two Words ' || o_custkey WHEN 2 THEN CAST(o_custkey AS VARCHAR) WHEN 3 THEN o_custkey || '.5'
        WHEN 7 THEN 'ball' WHEN 8 THEN 'True' WHEN 9 THEN 'False' END AS parsed FROM orders""",
    "nested_get": _with("games", """SELECT game_id,
        CASE WHEN game_key % 8 IN (1, 6, 7) THEN 'none' ELSE 'Arena ' || (cust % 50) END AS arena_name,
        CASE WHEN game_key % 8 IN (1, 6, 7) THEN 'none' END AS arena_state FROM games"""),
    "truthy_coalesce": f"""SELECT o_orderkey,
        CASE WHEN {_truthy('a')} THEN {_operand('a')} WHEN {_truthy('b')} THEN {_operand('b')}
             ELSE {_operand('c')} END AS first_of_three,
        CASE WHEN {_truthy('a')} THEN {_operand('a')} ELSE {_operand('b')} END AS first_of_two,
        CASE WHEN a <> 8 THEN {_operand('a')} ELSE {_operand('b')} END AS present_of_two
        FROM (SELECT *, o_orderkey % 10 AS a, o_orderkey // 10 % 10 AS b,
              CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey // 100 % 10 END AS c FROM orders)""",
    "game_structure": _with("games summaries", """SELECT game_id, season, CAST(game_date AS VARCHAR) AS game_date,
        CASE WHEN game_key % 8 <> 2 THEN CAST(epoch(CAST(game_date AS TIMESTAMP)) AS BIGINT)
            + (cust % 24) * 3600 + (game_key % 60) * 60 END AS game_epoch,
        home_team_id, away_team_id, game_status,
        CASE WHEN game_key % 8 <> 6 THEN 'Arena ' || (cust % 50) END AS arena_name,
        CASE WHEN game_key % 8 <> 6 AND cust % 3 <> 0 THEN 'City' || (cust % 50) END AS arena_city,
        CAST(NULL AS VARCHAR) AS arena_state
        FROM summaries WHERE reject_reason IS NULL"""),
    "game_rejects": _with("games summaries", """SELECT game_id, season, reject_reason FROM summaries
        WHERE reject_reason IS NOT NULL"""),
    "team_dim_rows": _with("games summaries dims", "SELECT * FROM dims"),
    "upsert_dim_teams": _with("games summaries dims", "SELECT coalesce(n.team_id, o.team_id) AS team_id, "
        + _new_or_old(("abbreviation", "team_name", "city", "full_name")) + ", o.conference, " + _ACTION.format(k="team_id")
        + """ FROM (SELECT DISTINCT home_team_id AS team_id, 'OLD' AS abbreviation, CAST(NULL AS VARCHAR) AS team_name,
            'Old City' AS city, CAST(NULL AS VARCHAR) AS full_name, 'East' AS conference
            FROM games WHERE home_team_id % 2 = 0) o
        FULL JOIN (SELECT team_id, """
        + ", ".join(
            f"arg_max({c}, game_id || pos) FILTER ({c} IS NOT NULL) AS {c}"
            for c in ("abbreviation", "team_name", "city", "full_name")
        )
        + " FROM dims GROUP BY team_id) n ON n.team_id = o.team_id"),
    "upsert_fact_games": _with("games", f"""SELECT coalesce(n.game_id, o.game_id) AS game_id,
        coalesce(n.season, o.season) AS season, CAST(coalesce(n.game_date, o.game_date) AS VARCHAR) AS game_date,
        coalesce(n.home_team_id + 2, o.home_team_id) AS home_team_id,
        coalesce(n.away_team_id, o.away_team_id) AS away_team_id,
        CASE WHEN o.game_id IS NOT NULL THEN CAST(99 AS INT) END AS home_points,
        coalesce(n.game_status || '2', o.game_status) AS game_status,
        CASE WHEN n.game_id IS NULL THEN 'Old Arena' END AS arena_name,
        CASE WHEN n.game_id IS NOT NULL THEN 'City' END AS arena_city, {_ACTION.format(k='game_id')}
        FROM (SELECT * FROM games WHERE game_key % 7 <> 0) o
        FULL JOIN (SELECT * FROM games WHERE game_key % 3 = 0 OR game_key % 7 = 0) n ON n.game_id = o.game_id"""),
    "side_unpivot": _with("games", """
        SELECT game_id, CAST(home_team_id AS BIGINT) AS team_id,
            (game_key + CASE WHEN game_key % 8 = 4 THEN 2 ELSE 0 END) % 5 AS fgm FROM games
        WHERE game_key % 11 <> 0 AND game_key % 8 <= 6 AND NOT (home_team_id = away_team_id AND game_key % 8 <= 3)
        UNION ALL
        SELECT game_id, CAST(away_team_id AS BIGINT), (game_key + 1) % 5 FROM games
        WHERE game_key % 11 <> 0 AND game_key % 8 <= 4 AND NOT (home_team_id = away_team_id AND game_key % 8 = 4)"""),
    "teambox_rows": _with("games boxdocs boxsides boxrows", f"""SELECT game_id, season, pos, team_id, is_home,
        opponent_team_id, {_TEAMBOX_SHOWN} FROM boxrows"""),
    "teambox_rejects": _with("games boxdocs", """SELECT game_id, reject_reason FROM boxdocs
        WHERE reject_reason IS NOT NULL"""),
    "teambox_zeros_kept": _with("games boxdocs boxsides boxrows", """SELECT game_id, pos, team_id,
        kept_pts AS pts, kept_off_rating AS off_rating FROM boxrows"""),
    "upsert_teambox": _with("games sides tbox", f"""SELECT coalesce(n.game_id, o.game_id) AS game_id,
        coalesce(n.team_id, o.team_id) AS team_id,
        {_keep_or_new(("season", "is_home", "opponent_team_id", "minutes", *TEAM_STATS, *TEAM_RATINGS), "game_id")},
        {_ACTION.format(k="game_id")}
        FROM (SELECT * REPLACE (CAST(1 AS INT) AS pts) FROM tbox
              WHERE game_key % 4 <> 0) o
        FULL JOIN (SELECT * REPLACE (pts + 2 AS pts, CAST(NULL AS VARCHAR) AS minutes) FROM tbox
                   WHERE game_key % 2 = 0
                   QUALIFY row_number() OVER (PARTITION BY game_id, team_id ORDER BY side DESC) = 1) n
        ON n.game_id = o.game_id AND n.team_id = o.team_id"""),
    "playerbox_rows": _with("games playerdocs listed", """SELECT game_id, season, CAST(i AS INT) AS pos,
        CAST(p AS INT) AS player_id, CAST(t AS INT) AS team_id,
        CASE WHEN t = home_team_id THEN true WHEN t = away_team_id THEN false END AS is_home,
        CASE WHEN t = home_team_id THEN away_team_id WHEN t = away_team_id THEN home_team_id END AS opponent_team_id,
        CAST(NULL AS BOOLEAN) AS starter_flag, (i + 10) || ':30' AS minutes,
        CAST((cust + i) % 3 AS INT) AS pts, CAST(i AS INT) AS reb, CAST(NULL AS INT) AS ast,
        CAST(i - 3 AS INT) AS plus_minus,
        nullif(trim(CASE WHEN (p + i) % 3 <> 0 THEN 'First' || p ELSE '' END || ' ' ||
                    CASE WHEN p % 4 <> 0 THEN 'Last' || (p + i) ELSE '' END), '') AS full_name
        FROM listed"""),
    "playerbox_rejects": _with("games playerdocs", """SELECT game_id, reject_reason FROM playerdocs
        WHERE reject_reason IS NOT NULL"""),
    "player_dim_seed": _with("games pbox", f"""SELECT game_id, player_id, team_id, minutes, pts FROM pbox
        QUALIFY row_number() OVER (PARTITION BY game_id, player_id ORDER BY {_ENTRY_KEYS}) = 1"""),
    "upsert_dim_players": _with("games pbox", f""", seeds AS (SELECT player_id, game_date, game_id,
            CASE WHEN s2 % 3 <> 0 THEN 'First' || player_id || '-' || team_id END AS first_name,
            CASE WHEN s3 % 4 <> 0 THEN 'Last' || player_id END AS last_name,
            CASE WHEN s1 % 2 = 0 THEN '' WHEN s1 % 3 = 0 THEN minutes END AS position FROM pbox
            QUALIFY row_number() OVER (PARTITION BY game_id, player_id ORDER BY {_ENTRY_KEYS}) = 1),
        named AS (SELECT *, nullif(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')), '') AS full_name FROM seeds),
        n AS (SELECT player_id, """
        + ", ".join(
            f"arg_max({c}, CAST(game_date AS VARCHAR) || game_id) FILTER ({c} IS NOT NULL) AS {c}"
            for c in ("full_name", "first_name", "last_name", "position")
        )
        + """ FROM named GROUP BY player_id),
        o AS (SELECT DISTINCT player_id, 'Old Name' AS full_name, CAST(NULL AS VARCHAR) AS first_name,
            CAST(NULL AS VARCHAR) AS last_name, 'C' AS position, '6-6' AS height FROM pbox WHERE player_id % 3 = 0)
        SELECT coalesce(n.player_id, o.player_id) AS player_id, """
        + _new_or_old(("full_name", "first_name", "last_name", "position"))
        + ", o.height, " + _ACTION.format(k="player_id") + " FROM o FULL JOIN n ON n.player_id = o.player_id"),
    "upsert_playerbox": _with("games pbox", f"""SELECT coalesce(n.game_id, o.game_id) AS game_id,
        coalesce(n.player_id, o.player_id) AS player_id,
        {_keep_or_new(("team_id", "season", "starter_flag", "minutes", "pts", "reb", "fgm", "plus_minus"), "game_id")},
        {_ACTION.format(k="game_id")}
        FROM (SELECT *, true AS starter_flag FROM pbox WHERE game_key % 3 = 0 OR game_key % 5 = 0
              QUALIFY row_number() OVER (PARTITION BY game_id, player_id ORDER BY {_ENTRY_KEYS}) = 1) o
        FULL JOIN (SELECT *, CAST(NULL AS BOOLEAN) AS starter_flag FROM pbox WHERE game_key % 5 <> 0
              QUALIFY row_number() OVER (PARTITION BY game_id, player_id ORDER BY {_ENTRY_LAST}) = 1) n
        ON n.game_id = o.game_id AND n.player_id = o.player_id"""),
    "season_of_dates": """SELECT o_orderkey,
        CAST(y AS VARCHAR) || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season, '2024-25' AS overridden
        FROM (SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate)
              ELSE year(o_orderdate) - 1 END AS y FROM orders)""",
    "season_format_a": f"SELECT *, {_season_ok(1000, 9999)} AS valid FROM ({_SEASON_TEXTS})",
    "season_format_b": f"SELECT *, {_season_ok(1946, 2100)} AS valid FROM ({_SEASON_TEXTS})",
    "validate_games": _with("dirty", _violations("dirty", "game_key", GAME_RULES)),
    "validate_teambox": _with("games sides tbox dtbox", _violations("dtbox", "game_key, side", TEAMBOX_RULES)),
    "validate_playerbox": _with("games pbox dpbox", _violations("dpbox", "game_key, player_id", PLAYERBOX_RULES)),
    "violation_summary": _with("games dirty sides tbox dtbox pbox dpbox", "SELECT entity, field, rule, count(*) AS violations FROM ("
        + "\nUNION ALL ".join(
            f"SELECT '{e}' AS entity, field, rule FROM ({_violations(src, '', rules)})"
            for e, src, rules in (
                ("game", "dirty", GAME_RULES), ("teambox", "dtbox", TEAMBOX_RULES), ("playerbox", "dpbox", PLAYERBOX_RULES),
            )
        ) + ") GROUP BY ALL"),
    "quality_passing": _with("games sides tbox", """SELECT game_id, side, pts FROM tbox WHERE fgm <= fga
        AND fg3m <= fg3a AND ftm <= fta AND pts >= 0 AND NOT (reb > 0 AND abs(reb - oreb - dreb) > 5)"""),
    "fk_orphans": _with("games pbox", _ORPHANS),
    "cascade_delete": _with("games sides tbox", "SELECT game_id, side, pts FROM tbox WHERE game_key % 7 <> 0"),
    "constraint_violations": _with("games pbox", """SELECT 'unique:game_id,player_id' AS "constraint",
        count(*) AS violations FROM (SELECT 1 FROM pbox GROUP BY game_id, player_id HAVING count(*) > 1)"""),
    "game_constraint_violations": _with("dirty", """SELECT * FROM (
        SELECT 'not_null:game_id' AS "constraint", count(*) FILTER (game_id IS NULL) AS violations FROM dirty
        UNION ALL SELECT 'not_null:season', count(*) FILTER (season IS NULL) FROM dirty
        UNION ALL SELECT 'not_null:game_date', count(*) FILTER (game_date IS NULL) FROM dirty
        UNION ALL SELECT 'not_null:away_team_id', count(*) FILTER (away_team_id IS NULL) FROM dirty
        UNION ALL SELECT 'length:season', count(*) FILTER (length(season) > 7) FROM dirty) WHERE violations > 0"""),
    "atomic_games": _with("games pbox", f"""SELECT game_id, count(*) AS rows FROM pbox
        WHERE game_id NOT IN (SELECT game_id FROM ({_ORPHANS})) GROUP BY game_id"""),
    "errors_append": _with("games summaries", f"""SELECT 'games' AS process_name, game_id,
        reject_reason AS error_type, {_REASON_TEXT} AS error_message, CAST(NULL AS VARCHAR) AS stack_trace,
        CAST(0 AS INT) AS retry_count, false AS is_resolved FROM summaries WHERE reject_reason IS NOT NULL"""),
    "errors_resolve": _with("games errs", """SELECT id, process_name, game_id, is_resolved OR hit AS is_resolved,
        hit AND NOT is_resolved AS changed
        FROM (SELECT *, coalesce(process_name = 'load_1' AND game_id IN
              (SELECT game_id FROM games WHERE game_key % 3 = 0), false) AS hit FROM errs)"""),
    "errors_failed_ids": _with("errs", """SELECT game_id FROM (SELECT game_id, max(created_at) AS m FROM errs
        WHERE process_name = 'load_2' AND NOT is_resolved AND game_id IS NOT NULL GROUP BY game_id
        ORDER BY m DESC, game_id LIMIT 100)"""),
    "errors_failed_ids_all": _with("errs", """SELECT DISTINCT game_id FROM errs
        WHERE process_name = 'load_2' AND NOT is_resolved AND game_id IS NOT NULL"""),
    "errors_totals": _with("errs recent_errs", """SELECT count(*) AS total_errors,
        count(*) FILTER (NOT is_resolved) AS unresolved FROM recent_errs"""),
    "errors_by_process": _with("errs recent_errs", """SELECT process_name, count(*) AS errors FROM recent_errs
        GROUP BY process_name"""),
    "errors_by_type": _with("errs recent_errs", """SELECT error_type, count(*) AS errors FROM recent_errs
        GROUP BY error_type"""),
    "errors_summary": _with("errs recent_errs", """SELECT count(*) AS total_errors,
        count(*) FILTER (NOT is_resolved) AS unresolved,
        (SELECT string_agg(n || '=' || c, ',' ORDER BY n) FROM
            (SELECT process_name AS n, count(*) AS c FROM recent_errs GROUP BY 1)) AS by_process,
        (SELECT string_agg(n || '=' || c, ',' ORDER BY n) FROM
            (SELECT error_type AS n, count(*) AS c FROM recent_errs GROUP BY 1)) AS by_type
        FROM recent_errs"""),
    "errors_recent_open": _with("errs", """SELECT process_name, game_id, error_type, error_message,
        strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM
        (SELECT * FROM errs WHERE NOT is_resolved ORDER BY created_at DESC, id DESC LIMIT 10)"""),
    "stage_report": _with("games summaries boxdocs playerdocs", """SELECT stage, season,
        count(*) FILTER (reject_reason IS NULL) AS success, count(*) FILTER (reject_reason IS NOT NULL) AS failed,
        count(*) AS attempted FROM (
        SELECT 'games' AS stage, season, reject_reason FROM summaries
        UNION ALL SELECT 'teambox', season, reject_reason FROM boxdocs
        UNION ALL SELECT 'playerbox', season, reject_reason FROM playerdocs) GROUP BY stage, season"""),
    "backfill_summary": _with("games", """SELECT ok, count(*) AS seasons, string_agg(season, ', ' ORDER BY season) AS season_list
        FROM (SELECT DISTINCT season, season NOT IN ('1996-97', '1995-96', '1994-95') AS ok FROM games
              WHERE game_key % 17 <> 0 AND game_key % 19 <> 0) GROUP BY ok"""),
    "retry_worklist": _with("games errs", f"""SELECT game_id, season {_MISSING_TEAMBOX} AND game_id IN
        (SELECT game_id FROM errs WHERE process_name = 'load_2' AND NOT is_resolved AND game_id IS NOT NULL)"""),
    "retry_newest": _with("games errs", f"""SELECT m.game_id, season, attempts FROM
        (SELECT game_id, season {_MISSING_TEAMBOX}) m JOIN
        (SELECT game_id, CAST(max(id % 4) AS INTEGER) AS attempts, max(created_at) AS last FROM errs
         WHERE process_name = 'load_2' AND NOT is_resolved AND game_id IS NOT NULL GROUP BY game_id
         HAVING max(created_at) + to_seconds([120, 200, 250][least(max(id % 4), 2) + 1]) <= TIMESTAMP '2024-01-31'
         ORDER BY last DESC, game_id LIMIT 100) f ON m.game_id = f.game_id"""),
    "stamps": _with("games", """SELECT 'fact_games' AS table_name, game_id,
        CASE WHEN game_key % 3 = 0 THEN '2024-01-31 00:00:00' ELSE '2024-01-30 06:00:00' END AS stamp
        FROM games WHERE game_key % 5 <> 0 OR game_key % 3 = 0
        UNION ALL SELECT 'spine', game_id, CASE WHEN game_key % 5 <> 0 THEN '2024-01-30 06:00:00' ELSE '2024-01-31 00:00:00' END
        FROM games WHERE game_key % 5 <> 0 OR game_key % 3 = 0"""),
    "truncate_tables": _with("games sides tbox", """SELECT 'spine' AS table_name, count(*) AS before, CAST(0 AS BIGINT) AS after FROM games
        UNION ALL SELECT 'fact_games', count(*), 0 FROM games UNION ALL SELECT 'teambox_pergame', count(*), 0 FROM tbox"""),
    "failure_ledger": _with("errs", """SELECT game_id, error_type,
        error_message || CASE WHEN id % 3 = 0 THEN '|retry|later' ELSE '' END AS message
        FROM errs WHERE game_id IS NOT NULL"""),
    "lineup_failure_ledger": _with("errs", """SELECT game_id, CAST(id % 30 AS VARCHAR) AS team_id, error_type,
        error_message AS message FROM errs WHERE game_id IS NOT NULL"""),
    "lineup_rejects": _with("games", """SELECT season, CASE WHEN game_key % 9 = 0 THEN 'missing_lineup_columns' ELSE 'out_of_range' END AS reject_reason,
        count(*) AS documents FROM games WHERE game_key % 9 = 0 OR (game_key % 8 = 0 AND game_key % 23 = 0) GROUP BY ALL"""),
    "lineup_upsert": _with("games", f""", g AS (SELECT *, unnest(range(0, 3)) AS i FROM games
            WHERE game_key % 9 <> 0 AND NOT (game_key % 8 = 0 AND game_key % 23 = 0)),
        n AS (SELECT season, home_team_id AS team_id, CAST(2 + game_key % 4 AS INT) AS group_quantity,
            '-' || ((cust + i) % 40) || '-' AS group_id, 'Group ' || ((cust + i) % 40) AS group_name,
            CAST(1 + (cust + i) % 82 AS INT) AS gp, CAST((cust + i) % 41 AS INT) AS w,
            CAST(game_key % 48 + 0.5 AS DOUBLE) AS min, CAST(game_key % 120 AS INT) AS pts,
            CAST(i - 1 AS INT) AS plus_minus FROM g
            QUALIFY row_number() OVER (PARTITION BY 1, season, home_team_id, game_key % 4, (cust + i) % 40
                                       ORDER BY game_key DESC, i DESC) = 1),
        o AS (SELECT DISTINCT season, home_team_id AS team_id, CAST(3 AS INT) AS group_quantity, '-0-' AS group_id,
            CAST(NULL AS VARCHAR) AS group_name, CAST(-1 AS INT) AS gp, CAST(NULL AS INT) AS w,
            CAST(NULL AS DOUBLE) AS min, CAST(NULL AS INT) AS pts, CAST(NULL AS INT) AS plus_minus
            FROM games WHERE game_key % 4 = 1)
        SELECT {", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in LINEUP_KEY)},
            {_keep_or_new(("group_name", "gp", "w", "min", "pts", "plus_minus"), "season")},
            {_ACTION.format(k="season")}
        FROM o FULL JOIN n USING ({", ".join(LINEUP_KEY)})"""),
    "team_record": _with("games sides tbox scored", """SELECT season, team_id, count(*) AS games,
        count(*) FILTER (win = 1) AS wins, count(*) FILTER (pts < opponent_pts) AS losses,
        avg(off_rating) AS avg_off_rating, avg(def_rating) AS avg_def_rating, avg(net_rating) AS avg_net_rating
        FROM scored GROUP BY season, team_id"""),
    "win_trend": _with("games sides tbox scored", """SELECT season, team_id, CAST(game_date AS VARCHAR) AS game_date,
        game_id, coalesce(win, 0) AS win,
        CAST(sum(coalesce(win, 0)) OVER w AS BIGINT) AS running_wins, count(*) OVER w AS running_games FROM scored
        WINDOW w AS (PARTITION BY season, team_id ORDER BY scored.game_date, game_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "player_averages": _with("games pbox", """SELECT season, player_id, count(*) AS games, avg(pts) AS avg_pts,
        avg(reb) AS avg_reb, avg(ast) AS avg_ast, avg(stl) AS avg_stl, avg(blk) AS avg_blk, avg(tov) AS avg_tov,
        CAST(sum(fgm) AS DOUBLE) / nullif(sum(fga), 0) AS fg_share,
        CAST(sum(fg3m) AS DOUBLE) / nullif(sum(fg3a), 0) AS fg3_share,
        CAST(sum(ftm) AS DOUBLE) / nullif(sum(fta), 0) AS ft_share
        FROM pbox GROUP BY season, player_id"""),
    "game_box": _with("games pbox", """SELECT game_id, season, CAST(game_date AS VARCHAR) AS game_date, team_id,
        'Team ' || team_id AS team, player_id, p_name AS player, team_id = home_team_id AS is_home, minutes, pts, reb, ast
        FROM pbox JOIN (SELECT 1 + p_partkey % 450 AS p, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY 1) ON p = player_id
        WHERE team_id IN (SELECT home_team_id FROM games)"""),
    "season_change": _with("games sides tbox", """SELECT team_id, season, pts,
        pts - lag(pts) OVER w AS pts_change, net - lag(net) OVER w AS net_change
        FROM (SELECT team_id, season, CAST(sum(pts) AS BIGINT) AS pts, avg(net_rating) AS net FROM tbox GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY team_id ORDER BY season)"""),
    "empty_team_boxes": _with("games boxdocs boxsides boxrows", """SELECT game_id, team_id, season FROM boxrows
        WHERE s IS NULL"""),
    "daily_run_idempotent": _with("games completed summaries dims boxdocs boxsides boxrows playerdocs listed", """,
        spine AS (SELECT DISTINCT game_id FROM completed),
        loaded AS (SELECT game_id FROM summaries WHERE reject_reason IS NULL AND game_id IN (SELECT game_id FROM spine)),
        teams AS (SELECT DISTINCT team_id FROM dims WHERE game_id IN (SELECT game_id FROM loaded)),
        boxes AS (SELECT * FROM boxdocs WHERE reject_reason IS NULL AND game_id IN (SELECT game_id FROM loaded)
            AND home_team_id IN (SELECT team_id FROM teams) AND away_team_id IN (SELECT team_id FROM teams)),
        entries AS (SELECT * FROM listed WHERE game_id IN (SELECT game_id FROM loaded) AND game_id NOT IN
            (SELECT game_id FROM listed WHERE t NOT IN (SELECT team_id FROM teams))),
        facts AS (SELECT *, CASE WHEN game_key % 8 <> 6 THEN 'Arena ' || (cust % 50) END AS arena_name,
            CASE WHEN game_key % 8 <> 6 AND cust % 3 <> 0 THEN 'City' || (cust % 50) END AS arena_city
            FROM summaries WHERE game_id IN (SELECT game_id FROM loaded)),
        dim AS (SELECT team_id, """
        + ", ".join(f"arg_max({c}, season || game_id || pos) FILTER ({c} IS NOT NULL) AS {c}" for c in ("abbreviation", "team_name", "city", "full_name"))
        + """ FROM dims JOIN (SELECT game_id, season FROM loaded JOIN games USING (game_id)) USING (game_id) GROUP BY team_id),
        people AS (SELECT p, arg_max(full_name, season || CAST(game_date AS VARCHAR) || game_id) FILTER (full_name IS NOT NULL) AS full_name
            FROM (SELECT *, nullif(trim(CASE WHEN (p + i) % 3 <> 0 THEN 'First' || p ELSE '' END || ' ' ||
                      CASE WHEN p % 4 <> 0 THEN 'Last' || (p + i) ELSE '' END), '') AS full_name FROM entries
                  QUALIFY row_number() OVER (PARTITION BY game_id, p ORDER BY i) = 1) GROUP BY p),
        boxed AS (SELECT * FROM boxrows WHERE game_id IN (SELECT game_id FROM boxes)),
        played AS (SELECT *, CASE WHEN t = home_team_id THEN true WHEN t = away_team_id THEN false END AS is_home FROM entries
            QUALIFY row_number() OVER (PARTITION BY game_id, p ORDER BY i DESC) = 1)
        SELECT 'spine' AS table_name, """ + _row_text("game_id", "season") + """ AS row_text FROM (SELECT DISTINCT game_id, season FROM completed)
        UNION ALL SELECT 'fact_games', """ + _row_text("game_id", "season", "game_date", "home_team_id", "away_team_id", "game_status", "arena_name", "arena_city") + """ FROM facts
        UNION ALL SELECT 'dim_teams', """ + _row_text("team_id", "abbreviation", "team_name", "city", "full_name") + """ FROM dim
        UNION ALL SELECT 'dim_players', """ + _row_text("p", "full_name") + """ FROM people
        UNION ALL SELECT 'teambox_pergame', """ + _row_text("game_id", "team_id", "season", "is_home", "opponent_team_id", "minutes", "pts", "fgm", "fga", "ast", "stl") + """ FROM boxed
        UNION ALL SELECT 'playerbox_pergame', """ + _row_text("game_id", "p", "t", "season", "is_home", "(i + 10) || ':30'", "(cust + i) % 3", "i", "i - 3") + """ FROM played"""),
}

# Reports from kept sums show what the reports over all rows show.
for _name in ("team_record", "season_change", "player_averages", "win_trend"):
    TWINS[f"{_name}_kept"] = TWINS[_name]
