"""Shot features, design matrix and an expected-goals model on ``pyspark.ml``."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icetally.functions.clock import to_double
from icetally.functions.columns import ensure_columns
from icetally.functions.events import CHANGES, XG_EVENTS
from icetally.functions.geometry import rink_geometry
from icetally.operators.forest import compile_forest, filled, forest_score, inputs_of
from icetally.operators.ordered import in_order

# The model's inputs.
NUMERIC = (
    "distanceFromGoal", "angle_signed", "x_norm", "y_norm", "Per", "timeInPeriodSec",
    "timeRemainingSec", "strengthDiff", "scoreDiff", "timeDiff", "shooterSkaters",
    "defendingSkaters", "previousEventDistanceFromGoal", "previousEventAngleSigned",
    "previousEventXNorm", "previousEventYNorm",
)
FLAGS = ("isRebound", "isHome", "shootEmptyNet", "previousEventSameTeam")
CATEGORIES = ("shotType", "strength", "previousEvent")

_NEEDED = {
    "gameId": "bigint", "elapsedTime": "int", "Event": "string", "eventTeam": "string",
    "homeTeam": "string", "awayTeam": "string", "xCoord": "double", "yCoord": "double",
    "homeScore": "int", "awayScore": "int", "home_on_count": "int", "away_on_count": "int",
    "pulled_home": "int", "pulled_away": "int",
}


def _same(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def engineer_xg_features(
    pbp: DataFrame, goal_x: float = 89.0, goal_y: float = 0.0, rebound_window_s: int = 3,
    on_off_events: tuple[str, ...] = CHANGES, shot_like_events_prev: tuple[str, ...] = ("SHOT",),
    shot_like_events: tuple[str, ...] | None = None, order: str = "seq", whole: bool = False,
) -> DataFrame:
    """Adds geometry, strength, score, empty-net, previous-play and rebound columns.

    A rebound is a ``shot_like_events`` play (default: the same types as the parent) by the team of the
    previous play, itself one of ``shot_like_events_prev``, within the window. Score differences are
    those before a goal. ``order`` names the column that orders plays of one second: the place in the source, or
    ``#`` of a table that is in its final order. ``whole`` says that the rows of any game fit into one task.
    """
    df = rink_geometry(ensure_columns(pbp, _NEEDED), goal_x, goal_y)
    home = _same(F.col("eventTeam"), F.col("homeTeam"))
    away = _same(F.col("eventTeam"), F.col("awayTeam"))
    goal = _same(F.col("Event"), F.lit("GOAL"))

    def oriented(h: Column, a: Column) -> Column:
        return F.when(home, h).when(away, a)

    hn, an = to_double(F.col("home_on_count")), to_double(F.col("away_on_count"))
    hs = to_double(F.col("homeScore")) - F.when(goal & home, 1).otherwise(0)
    as_ = to_double(F.col("awayScore")) - F.when(goal & ~home & away, 1).otherwise(0)
    empty_home = F.coalesce(to_double(F.col("pulled_home")) == 1, F.lit(False))
    empty_away = F.coalesce(to_double(F.col("pulled_away")) == 1, F.lit(False))
    df = df.withColumns({
        "isHome": home,
        "strengthDiff": oriented(hn - an, an - hn),
        "scoreDiff": oriented(hs - as_, as_ - hs),
        "shooterSkaters": oriented(hn, an),
        "defendingSkaters": oriented(an, hn),
        "shootEmptyNet": (home & empty_away) | (away & empty_home),
        "elapsedTime": F.col("elapsedTime").try_cast("int"),
        "isGoal": goal,
    })
    play = ~F.coalesce(F.col("Event").isin(*on_off_events), F.lit(False))
    df = in_order(
        df, [F.col(order)],
        previous={
            "previousEvent": F.col("Event"), "previousTeam": F.col("eventTeam"),
            "previousElapsedTime": F.col("elapsedTime"),
            "previousEventDistanceFromGoal": F.col("distanceFromGoal"),
            "previousEventAngleSigned": F.col("angle_signed"),
            "previousEventXNorm": F.col("x_norm"), "previousEventYNorm": F.col("y_norm"),
        },
        among=play, whole=whole,
    )
    same_team = _same(F.col("previousTeam"), F.col("eventTeam"))
    gap = F.col("elapsedTime") - F.col("previousElapsedTime")
    current = shot_like_events_prev if shot_like_events is None else shot_like_events
    rebound = (
        F.coalesce(F.col("previousEvent").isin(*shot_like_events_prev), F.lit(False))
        & F.coalesce(F.col("Event").isin(*current), F.lit(False))
        & same_team & F.coalesce(gap.between(0, rebound_window_s), F.lit(False))
    )
    return df.withColumns({
        "previousEventSameTeam": F.when(play, same_team),
        "timeDiff": gap,
        "isRebound": F.when(play, rebound),
    })


def shots_design_matrix(pbp: DataFrame) -> DataFrame:
    """Shot rows with numeric inputs as doubles, flags as 0/1 and categories as trimmed text."""
    wanted = {c: "double" for c in NUMERIC} | {c: "boolean" for c in FLAGS} | {c: "string" for c in CATEGORIES}
    shots = ensure_columns(pbp, wanted | {"Event": "string"}).where(F.col("Event").isin(*XG_EVENTS))
    return shots.withColumns(
        {c: to_double(F.col(c)) for c in NUMERIC}
        | {c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)).cast("int") for c in FLAGS}
        | {c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("<NA>")) for c in CATEGORIES}
    )


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replaces each category by one 0/1 column per level, named ``category_level``."""
    new = {f"{c}_{v}": (F.col(c) == v).cast("int") for c, vs in levels.items() for v in vs}
    return df.withColumns(new).drop(*levels)


def align_columns(df: DataFrame, train_cols: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the training columns in training order, missing ones as 0.0."""
    wanted = list(dict.fromkeys(train_cols))
    return df.select(
        *keep, *[(F.col(f"`{c}`") if c in df.columns else F.lit(0.0)).alias(c) for c in wanted]
    )


def fit_xg(pbp_features: DataFrame, seed: int = 7, max_iter: int = 20, max_depth: int = 4) -> PipelineModel:
    """Fits gradient-boosted trees on ``isGoal`` of the shot rows."""
    shots = shots_design_matrix(pbp_features).select(
        *NUMERIC, *FLAGS, *CATEGORIES, F.col("isGoal").cast("double").alias("label")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    numeric = [f"n_{c}" for c in NUMERIC]
    stages = [
        *[StringIndexer(inputCol=c, outputCol=f"i_{c}", handleInvalid="keep",
                        stringOrderType="alphabetAsc") for c in CATEGORIES],
        OneHotEncoder(inputCols=[f"i_{c}" for c in CATEGORIES], outputCols=[f"o_{c}" for c in CATEGORIES],
                      handleInvalid="keep"),
        Imputer(inputCols=list(NUMERIC), outputCols=numeric),
        VectorAssembler(inputCols=[*numeric, *FLAGS, *[f"o_{c}" for c in CATEGORIES]], outputCol="features",
                        handleInvalid="keep"),
        GBTClassifier(labelCol="label", featuresCol="features", seed=seed, maxIter=max_iter, maxDepth=max_depth),
    ]
    # an input nobody has a value for cannot be imputed by its mean
    known = shots.agg(*[F.count(c).alias(c) for c in NUMERIC]).first()
    empty = [c for c in NUMERIC if known[c] == 0]
    training = shots.withColumns({c: F.lit(0.0) for c in empty}) if empty else shots
    try:
        return Pipeline(stages=stages).fit(training)
    finally:
        shots.unpersist()


def predict_xg(pbp_features: DataFrame, model: PipelineModel | dict, xg_col: str = "xG") -> DataFrame:
    """The input with an ``xg_col`` filled on shot rows, by a fitted pipeline or a forest (see ``operators.forest``).

    The trees become one expression that is evaluated on shot rows only; no vectors are built, nothing is joined back.
    """
    forest = model if isinstance(model, dict) else compile_forest(model)
    used = inputs_of(forest)
    wanted = {c: "double" for c in NUMERIC} | {c: "boolean" for c in FLAGS} | {c: "string" for c in CATEGORIES}
    if unknown := used - set(wanted):
        raise ValueError(f"inputs that shots do not have: {sorted(unknown)}")
    df = ensure_columns(pbp_features, wanted)
    shot = F.coalesce(F.col("Event").isin(*XG_EVENTS), F.lit(False))
    inputs = (
        {c: filled(forest, c, to_double(F.col(c))) for c in NUMERIC}
        | {c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)).cast("int") for c in FLAGS}
        | {c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("<NA>")) for c in CATEGORIES}
    )
    staged = df.withColumns({f"_in_{c}": inputs[c] for c in sorted(used)})
    scored = staged.withColumn(xg_col, F.when(shot, forest_score(forest, "_in_{}")))
    return scored.select(*[c for c in pbp_features.columns if c != xg_col], xg_col)
