"""Star schema, reports and the chain of stages."""
