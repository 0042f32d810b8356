"""Column rules that stay inside whole-stage codegen."""

from matchlake.functions.dtypes import spark_type
from matchlake.functions.results import match_points, match_result
from matchlake.functions.rules import load_rule_sql

__all__ = ["match_result", "match_points", "load_rule_sql", "spark_type"]
