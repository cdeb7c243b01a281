"""Compositions of operators into layers and jobs, the query registry and the
SQL oracle formulations."""
