"""Star schema of the match warehouse: column types, keys and constraints.

One explicit ``StructType`` per table is used for every read and write; no
schema is ever inferred (inference costs an extra pass over the data and turns
a column with one blank cell into text).

Deviation from the source DDL, on purpose: every id / key column is 64-bit
(``LongType``).  The source declares 32-bit INTEGER keys, which is enough for
its 25,000 matches but overflows long before 100 TB of facts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
STRING = T.StringType()


def _struct(cols: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# ---------------------------------------------------------------------------
# Column names and order of the eight warehouse tables, as
# declared by the source DDL.  Loading is positional, so the order matters.
# ---------------------------------------------------------------------------

COUNTRY = _struct([("id", LONG), ("name", STRING)])

LEAGUE = _struct([("id", LONG), ("country_id", LONG), ("name", STRING)])

TEAM = _struct([
    ("id", LONG),
    ("team_api_id", LONG),
    ("team_fifa_api_id", DOUBLE),
    ("team_long_name", STRING),
    ("team_short_name", STRING),
])

PLAYER = _struct([
    ("id", LONG),
    ("player_api_id", LONG),
    ("player_name", STRING),
    ("player_fifa_api_id", LONG),
    ("birthday", STRING),
    ("height", DOUBLE),
    ("weight", DOUBLE),
])

PLAYER_SKILLS = [
    "crossing", "finishing", "heading_accuracy", "short_passing", "volleys",
    "dribbling", "curve", "free_kick_accuracy", "long_passing", "ball_control",
    "acceleration", "sprint_speed", "agility", "reactions", "balance",
    "shot_power", "jumping", "stamina", "strength", "long_shots", "aggression",
    "interceptions", "positioning", "vision", "penalties", "marking",
    "standing_tackle", "sliding_tackle", "gk_diving", "gk_handling",
    "gk_kicking", "gk_positioning", "gk_reflexes",
]

PLAYER_ATTRIBUTES = _struct(
    [
        ("id", LONG),
        ("player_fifa_api_id", LONG),
        ("player_api_id", LONG),
        ("date", STRING),
        ("overall_rating", DOUBLE),
        ("potential", DOUBLE),
        ("preferred_foot", STRING),
        ("attacking_work_rate", STRING),
        ("defensive_work_rate", STRING),
    ]
    + [(s, DOUBLE) for s in PLAYER_SKILLS]
)

TEAM_STYLE = [
    ("buildUpPlaySpeed", DOUBLE), ("buildUpPlaySpeedClass", STRING),
    ("buildUpPlayDribbling", DOUBLE), ("buildUpPlayDribblingClass", STRING),
    ("buildUpPlayPassing", DOUBLE), ("buildUpPlayPassingClass", STRING),
    ("buildUpPlayPositioningClass", STRING),
    ("chanceCreationPassing", DOUBLE), ("chanceCreationPassingClass", STRING),
    ("chanceCreationCrossing", DOUBLE), ("chanceCreationCrossingClass", STRING),
    ("chanceCreationShooting", DOUBLE), ("chanceCreationShootingClass", STRING),
    ("chanceCreationPositioningClass", STRING),
    ("defencePressure", DOUBLE), ("defencePressureClass", STRING),
    ("defenceAggression", DOUBLE), ("defenceAggressionClass", STRING),
    ("defenceTeamWidth", DOUBLE), ("defenceTeamWidthClass", STRING),
    ("defenceDefenderLineClass", STRING),
]

TEAM_ATTRIBUTES = _struct(
    [("id", LONG), ("team_fifa_api_id", LONG), ("team_api_id", LONG), ("date", STRING)]
    + TEAM_STYLE
)

# Match: keys and context, 22 squad X and 22 squad Y coordinates, 22 line-up
# ids, 8 event text columns, then 10 odds providers x home/draw/away.
MATCH_EVENT_COLUMNS = [
    "goal", "shoton", "shotoff", "foulcommit", "card", "cross_stat", "corner", "possession",
]
ODDS_PROVIDERS = ["B365", "BW", "IW", "LB", "PS", "WH", "SJ", "VC", "GB", "BS"]


def _squad(prefix: str) -> list[tuple[str, T.DataType]]:
    return [(f"{side}_player_{prefix}{i}", INT if prefix else LONG)
            for side in ("home", "away") for i in range(1, 12)]


MATCH = _struct(
    [
        ("id", LONG),
        ("country_id", LONG),
        ("league_id", LONG),
        ("season", STRING),
        ("stage", INT),
        ("date", STRING),
        ("match_api_id", LONG),
        ("home_team_api_id", LONG),
        ("away_team_api_id", LONG),
        ("home_team_goal", INT),
        ("away_team_goal", INT),
    ]
    + _squad("X")
    + _squad("Y")
    + _squad("")
    + [(c, STRING) for c in MATCH_EVENT_COLUMNS]
    + [(p + r, DOUBLE) for p in ODDS_PROVIDERS for r in ("H", "D", "A")]
)

POINT = _struct([
    ("match_api_id", LONG),
    ("home_team_goal", INT),
    ("away_team_goal", INT),
    ("season", STRING),
    ("result", STRING),
    ("name", STRING),
])


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str
    # The 22 squad X coordinates are declared as references to Player(id) in
    # the source DDL; they hold pitch coordinates, so they are off by default.
    enabled: bool = True


@dataclass(frozen=True)
class TableDef:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: tuple[ForeignKey, ...] = ()
    comments: dict[str, str] = field(default_factory=dict)
    # Lengths of text columns that are cut on load; the source declares none.
    text_lengths: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


SKILL_TOPICS = {
    "crossing": "passes from the wings", "finishing": "shots close to goal",
    "heading_accuracy": "aim with the head", "short_passing": "passes over a few metres",
    "volleys": "shots before the ball lands", "dribbling": "runs with the ball",
    "curve": "spin on the ball", "free_kick_accuracy": "aim at free kicks",
    "long_passing": "passes over half the pitch", "ball_control": "first touch",
    "acceleration": "time to full speed", "sprint_speed": "full speed",
    "agility": "turning quickly", "reactions": "answering to the play", "balance": "staying upright",
    "shot_power": "force of a shot", "jumping": "height of a jump", "stamina": "lasting ninety minutes",
    "strength": "winning duels by body", "long_shots": "shots from outside the box",
    "aggression": "hardness in duels", "interceptions": "reading opposing passes",
    "positioning": "finding space in attack", "vision": "seeing free team mates",
    "penalties": "shots from the spot", "marking": "staying with an opponent",
    "standing_tackle": "winning the ball on foot", "sliding_tackle": "winning the ball on the ground",
    "gk_diving": "a keeper's dives", "gk_handling": "a keeper's grip",
    "gk_kicking": "a keeper's clearances", "gk_positioning": "a keeper's place in goal",
    "gk_reflexes": "a keeper's reactions",
}

PLAYER_ATTRIBUTE_COMMENTS = {
    "id": "Number of the rating row.",
    "player_fifa_api_id": "Key of the rated player in the ratings feed.",
    "player_api_id": "Key of the rated player in the match feed.",
    "date": "Day on which the rating was published, as text.",
    "overall_rating": "Rating of the player as a whole, up to 100.",
    "potential": "Highest rating the player is expected to reach.",
    "preferred_foot": "Foot used by choice: left or right.",
    "attacking_work_rate": "Effort when the team attacks: low, medium or high.",
    "defensive_work_rate": "Effort when the team defends: low, medium or high.",
} | {skill: f"Rating up to 100: {topic}." for skill, topic in SKILL_TOPICS.items()}

TABLES: dict[str, TableDef] = {
    "Country": TableDef(
        "Country", COUNTRY, ("id",), ("name",),
        comments={"id": "Number of the country row.",
                  "name": "Name of the country, as leagues refer to it."},
    ),
    "League": TableDef("League", LEAGUE, ("id",), ("name",)),
    "Team": TableDef("Team", TEAM, ("id",), ("team_api_id",)),
    "Team_Attributes": TableDef(
        "Team_Attributes", TEAM_ATTRIBUTES, ("id",), (),
        (ForeignKey("team_api_id", "Team", "team_api_id"),),
    ),
    "Player": TableDef(
        "Player", PLAYER, ("id",), ("player_api_id", "player_fifa_api_id"),
        comments={
            "id": "Number of the player row.",
            "player_api_id": "Key of the player in the match feed.",
            "player_name": "Full name as printed on the team sheet.",
            "player_fifa_api_id": "Key of the player in the ratings feed.",
            "birthday": "Day of birth, as text.",
            "height": "Body height in centimetres.",
            "weight": "Body weight in pounds.",
        },
    ),
    "Player_Attributes": TableDef(
        "Player_Attributes", PLAYER_ATTRIBUTES, ("id",), (),
        (
            ForeignKey("player_fifa_api_id", "Player", "player_fifa_api_id"),
            ForeignKey("player_api_id", "Player", "player_api_id"),
        ),
        comments=PLAYER_ATTRIBUTE_COMMENTS,
    ),
    "Match": TableDef(
        "Match", MATCH, ("id",), ("match_api_id",),
        (
            ForeignKey("country_id", "Country", "id"),
            ForeignKey("league_id", "League", "id"),
            ForeignKey("home_team_api_id", "Team", "team_api_id"),
            ForeignKey("away_team_api_id", "Team", "team_api_id"),
        )
        + tuple(
            ForeignKey(f"{side}_player_X{i}", "Player", "id", enabled=False)
            for side in ("home", "away") for i in range(1, 12)
        ),
    ),
    "Point": TableDef(
        "Point", POINT, (), (),
        (ForeignKey("match_api_id", "Match", "match_api_id"),),
        comments={
            "match_api_id": "Key of the match in the match feed.",
            "home_team_goal": "Goals of the home side at full time.",
            "away_team_goal": "Goals of the visiting side at full time.",
            "season": "Season, written as first/second year.",
            "result": "Who won: Home, Away or Tie.",
            "name": "Name of the league the match belongs to.",
        },
    ),
}

# Order in which the warehouse is (re)built: dimensions first, facts last.
# Tables of one level do not depend on each other and may load at the same time.
LOAD_LEVELS = [
    ["Country", "Team", "Player", "League"],
    ["Team_Attributes", "Player_Attributes", "Match"],
    ["Point"],
]


def ddl(schema: T.StructType, comments: dict[str, str] | None = None) -> str:
    """Column list for CREATE TABLE, with optional column comments."""
    comments = comments or {}
    parts = []
    for f in schema.fields:
        col = f"`{f.name}` {f.dataType.simpleString().upper()}"
        if f.name in comments:
            text = comments[f.name].replace("\\", "\\\\").replace("'", "\\'")
            col += f" COMMENT '{text}'"
        parts.append(col)
    return ", ".join(parts)
