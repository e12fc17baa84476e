"""Matching users to personas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.scripts import MAX_SCRIPTS, read_scripts, text_to_score, variables_of, with_script_texts
from tallyweave.operators.profile import entity_profile


def score_personas(
    user_persona: DataFrame,
    property_: DataFrame,
    evaluation: DataFrame,
    configs: dict[str, tuple[DataFrame, str, str]],
    limit: int = MAX_SCRIPTS,
) -> DataFrame:
    """Set score columns from scripts over the user's variables.

    ``configs`` maps a score column to (configuration, its script column, the id
    column of ``user_persona``).  All scripts share one profile and one join.  A
    result that is no number keeps the old score.
    """
    scripts = {col: read_scripts(conf, "id", script_col, limit) for col, (conf, script_col, _) in configs.items()}
    names = variables_of(s for by_id in scripts.values() for s in by_id.values())
    profile = entity_profile(property_, evaluation, "userKey", names)
    wanted = {f"__{col}": (F.col(id_col), scripts[col]) for col, (_, _, id_col) in configs.items()}
    joined = with_script_texts(user_persona.join(profile, "userKey", "left"), wanted)
    scores = {col: F.coalesce(text_to_score(F.col(f"__{col}")), F.col(col)).alias(col) for col in configs}
    return joined.select(*[scores.get(c, F.col(c)) for c in user_persona.columns])


def score_hierarchy(
    user_persona: DataFrame, property_: DataFrame, evaluation: DataFrame, hierarchies: DataFrame, limit: int = MAX_SCRIPTS
) -> DataFrame:
    return score_personas(
        user_persona, property_, evaluation, {"scoreHierarchy": (hierarchies, "expression", "hierarchyId")}, limit
    )


def score_phase(
    user_persona: DataFrame, property_: DataFrame, evaluation: DataFrame, phases: DataFrame, limit: int = MAX_SCRIPTS
) -> DataFrame:
    return score_personas(
        user_persona, property_, evaluation, {"scorePhase": (phases, "expression", "phaseId")}, limit
    )


def score_persona(
    user_persona: DataFrame, property_: DataFrame, evaluation: DataFrame, personas: DataFrame, limit: int = MAX_SCRIPTS
) -> DataFrame:
    return score_personas(
        user_persona, property_, evaluation, {"scorePersona": (personas, "expression", "personaId")}, limit
    )


def best_persona(user_persona: DataFrame) -> DataFrame:
    """The persona with the highest (hierarchy, phase, persona) scores of each user.

    Nulls rank last and ties go to the smallest persona id.  Spark keeps one row per
    user and input task before the shuffle (group limit of the window).
    """
    order = Window.partitionBy("userKey").orderBy(
        F.desc_nulls_last("scoreHierarchy"),
        F.desc_nulls_last("scorePhase"),
        F.desc_nulls_last("scorePersona"),
        "personaId",
    )
    return user_persona.withColumn("__n", F.row_number().over(order)).where("__n <= 1").drop("__n")
