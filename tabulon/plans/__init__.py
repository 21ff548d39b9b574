"""Plan inspection: what Catalyst chose, as text and as checks."""

from tabulon.plans.inspect import (
    has_node, physical_plan, python_udf_nodes, pushed_filters, read_schemas,
)

__all__ = ["has_node", "physical_plan", "python_udf_nodes", "pushed_filters", "read_schemas"]
