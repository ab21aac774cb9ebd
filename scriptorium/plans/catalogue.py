"""Every registered query of the library and its DuckDB SQL."""

from __future__ import annotations

from . import figure_plans, library_plans, registry_plans, section_plans

QUERIES = {**section_plans.QUERIES, **registry_plans.QUERIES, **library_plans.QUERIES, **figure_plans.QUERIES}
ORACLE_SQL = {**section_plans.ORACLE_SQL, **registry_plans.ORACLE_SQL, **library_plans.ORACLE_SQL, **figure_plans.ORACLE_SQL}
