"""Reports built from the operators: film pipelines and benchmark-table bindings."""
