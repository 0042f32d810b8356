"""Match outcome rules (F1) and the 3/1/0 points rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result labels of the points table.
HOME, AWAY, TIE = "Home", "Away", "Tie"

# Points for a win, a draw and a loss.
WIN_POINTS, DRAW_POINTS, LOSS_POINTS = 3, 1, 0


def match_result(home_goals: Column, away_goals: Column, strict: bool = False) -> Column:
    """'Home' / 'Away' / 'Tie' from the two goal counts.

    The warehouse rule is a plain CASE: a comparison with a NULL goal is not
    true, so a match with a missing score falls through to 'Tie'.  With
    ``strict=True`` such a match gets a NULL result instead.
    """
    label = F.when(home_goals > away_goals, F.lit(HOME)).when(
        home_goals < away_goals, F.lit(AWAY)
    )
    if strict:
        return label.when(home_goals == away_goals, F.lit(TIE))
    return label.otherwise(F.lit(TIE))


def match_points(goals_for: Column, goals_against: Column) -> Column:
    """Points one team earns in one match; NULL when a score is missing."""
    return (
        F.when(goals_for > goals_against, F.lit(WIN_POINTS))
        .when(goals_for == goals_against, F.lit(DRAW_POINTS))
        .when(goals_for < goals_against, F.lit(LOSS_POINTS))
    )
