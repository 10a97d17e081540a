"""Jobs and reports built from the operators."""
