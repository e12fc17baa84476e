"""Column layouts of the shared tables.

Amounts and weights are decimals so that sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

WEIGHT = "decimal(6,3)"
SCORE = "decimal(18,6)"
MONEY = "decimal(18,2)"
SHARE = "decimal(9,4)"

_TASK = "status string, priority int, revision int"

_LAYOUTS = {
    "mod_order": "id string, item string, amount decimal(18,2), order_time timestamp, platform string, "
    "trace_code string, commission_settlement decimal(18,2), status string",
    "mod_trace_code": "code string, platform string, broker_id string",
    "mod_profit_share_scheme": "id string, category string, platform string",
    "mod_profit_share_item": "id string, scheme_id string, beneficiary string, beneficiary_type string, share string",
    "mod_broker": "id string, parent_id string",
    "mod_clearing": "id string, platform string, order_id string, order_time timestamp, item string, "
    "amount_order decimal(18,2), amount_commission decimal(18,2), amount_profit decimal(18,2), scheme_id string, "
    "scheme_item_id string, beneficiary string, beneficiary_type string, share string, status_clear string, "
    "status_settle string, create_date timestamp, update_date timestamp",
    "mod_settlement": "id string, broker_id string, voucher string, type string, amount decimal(28,2), status string, "
    "create_date timestamp, update_date timestamp",
    "mod_item_category": "id string, name string, motivation_ids string, occasion_ids string",
    "mod_item_dimension": f"id string, parent_id string, parent_ids string, weight {WEIGHT}, category string",
    "mod_user_dimension": f"id string, parent_id string, parent_ids string, weight {WEIGHT}",
    "int_item_dimension_measure": f"dimension_id string, measure_id string, weight {WEIGHT}, category string",
    "int_user_dimension_measure": f"dimension_id string, measure_id string, weight {WEIGHT}",
    "mod_item_evaluation": f"id string, parent_id string, parent_ids string, weight {WEIGHT}, type string, "
    "script string, category string",
    "mod_user_evaluation": f"id string, parent_id string, parent_ids string, weight {WEIGHT}, type string, "
    "script string, category string",
    "int_item_evaluation_dimension": f"evaluation_id string, dimension_id string, weight {WEIGHT}, category string",
    "int_user_evaluation_dimension": f"evaluation_id string, dimension_id string, weight {WEIGHT}",
    "mod_measure": "id string, property string, category string",
    "mod_user_measure": "id string, property string",
    "mod_hierarchy": "id string, expression string",
    "mod_phase": "id string, expression string",
    "mod_persona": "id string, hierarchy_id string, phase_id string, expression string, alpha string, beta string, "
    "gamma string, delte string, epsilon string",
    "mod_motivation": "id string, name string",
    "mod_occasion": "id string, name string",
    "mod_life_style": "persona_id string, motivation_ids string, occasion_ids string",
    "property": f"property string, value string, category string, itemKey string, categoryId string, "
    f"propertyId string, score {SCORE}, rank int, status string, revision int",
    "user_property": f"property string, value string, userKey string, propertyId string, score {SCORE}, rank int, "
    "status string, revision int",
    "value": f"category string, property string, value string, score {SCORE}, rank int, status string, revision int",
    "user_value": f"property string, value string, score {SCORE}, rank int, status string, revision int",
    "measure": f"itemKey string, parent string, dimension string, weight {WEIGHT}, score {SCORE}, {_TASK}",
    "user_measure": f"userKey string, parent string, dimension string, weight {WEIGHT}, score {SCORE}, {_TASK}",
    "measure_property": f"itemKey string, dimension string, property string, weight {WEIGHT}, {_TASK}",
    "user_measure_property": f"userKey string, dimension string, property string, weight {WEIGHT}, {_TASK}",
    "evaluation": f"itemKey string, parent string, evaluation string, weight {WEIGHT}, type string, script string, "
    f"category string, featured boolean, score {SCORE}, text string, {_TASK}",
    "user_evaluation": f"userKey string, parent string, evaluation string, weight {WEIGHT}, type string, "
    f"script string, category string, persona string, featured boolean, score {SCORE}, text string, {_TASK}",
    "evaluation_measure": f"itemKey string, evaluation string, dimension string, weight {WEIGHT}, type string, "
    f"script string, category string, {_TASK}",
    "user_evaluation_measure": f"userKey string, evaluation string, dimension string, weight {WEIGHT}, type string, "
    f"script string, {_TASK}",
    "user_query": "userKey string, category string, type string, subType string, field string, text string, "
    "status string, revision int",
    "user_persona": f"userKey string, hierarchyId string, phaseId string, personaId string, "
    f"scoreHierarchy double, scorePhase double, scorePersona double, status string, revision int",
    "user_filter": "userKey string, status string, revision int",
    "recommendationTask": "id string, query string, type string, tags string, status string, revision int",
}


def table_schema(name: str) -> T.StructType:
    """The layout of one shared table."""
    return T.StructType.fromDDL(_LAYOUTS[name])


def table_names() -> list[str]:
    return list(_LAYOUTS)
