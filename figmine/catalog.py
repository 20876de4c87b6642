"""All registered queries of the engine and their SQL twins."""

from figmine.plans import layout_queries, other_queries, source_queries, state_queries, text_queries, vision_queries  # noqa: F401
from figmine.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
