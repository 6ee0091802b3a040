"""Compositions of operators: the report, the dashboard, SQL texts, materialisation, registry."""
