"""New documents to all tables they feed: one snapshot of each table per run."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyweave.operators import load
from tallyweave.operators.upsert import insert_ignore

# What makes a task row the same row.
TASK_KEYS = {
    "measure": ["dimension"],
    "measure_property": ["dimension", "property"],
    "evaluation": ["evaluation", "type"],
    "evaluation_measure": ["evaluation", "dimension", "type"],
}
QUERY_KEYS = ["userKey", "category", "subType", "field"]
_TABLE = {"item": "{}", "user": "user_{}"}


def task_rows(entities: DataFrame, conf: dict[str, DataFrame], twin: str) -> dict[str, DataFrame]:
    """The task rows of the entities by table name, leaves promoted."""
    key = f"{twin}Key"
    categories = conf["mod_item_category"] if twin == "item" else None
    dims, measured = conf[f"mod_{twin}_dimension"], conf[f"int_{twin}_dimension_measure"]
    evals, mapped = conf[f"mod_{twin}_evaluation"], conf[f"int_{twin}_evaluation_dimension"]
    return {
        "measure": load.promote_measured(load.measure_tasks(entities, dims, key, categories), measured),
        "measure_property": load.measure_property_tasks(entities, measured, key, categories),
        "evaluation": load.promote_evaluated(load.evaluate_tasks(entities, evals, key, categories), evals, mapped),
        "evaluation_measure": load.evaluation_measure_tasks(entities, evals, mapped, key, categories),
    }


def load_entities(
    entities: DataFrame, flat: DataFrame, tables: dict[str, DataFrame], conf: dict[str, DataFrame], twin: str
) -> dict[str, DataFrame]:
    """New snapshots of the tables that taken documents feed, by the tables' names.

    ``entities`` holds the taken documents' keys (and category for items), ``flat`` their
    flattened rows, ``tables`` the current snapshots.  Rows that are there already stay as they
    are: an entity that comes back doubles no task and resets no state.  Only tables named in
    ``tables`` are made.
    """
    key, name = f"{twin}Key", _TABLE[twin].format
    label = ["category", "property", "value"] if twin == "item" else ["property", "value"]
    row = [*label, key]
    made = {
        name("property"): lambda t: load.property_rows(t, flat, row),
        name("value"): lambda t: load.label_candidates(t, flat, label),
    }
    for task, rows in task_rows(entities, conf, twin).items():
        made[name(task)] = lambda t, rows=rows, task=task: insert_ignore(t, rows, [key, *TASK_KEYS[task]])
    if twin == "user":
        made["user_query"] = lambda t: insert_ignore(t, load.query_items(entities, conf["mod_user_evaluation"]), QUERY_KEYS)
        made["user_persona"] = lambda t: load.persona_tasks(t, entities, conf["mod_persona"])
        made["user_filter"] = lambda t: load.filter_tasks(t, entities)
    return {table: made[table](rows) for table, rows in tables.items()}
