"""duetto: two-sided (many-to-one) stable matching on Spark DataFrames.

The canonical table is ``edges``: one row per mutually acceptable pair with
columns ``doctor_id, hospital_id, doctor_rank, hospital_rank`` (lower rank =
more preferred).  Everything else -- preference lists, matchings, rosters,
verification reports -- is derived from it with Spark column expressions,
windows, joins and aggregates.

Sub-packages
------------
sources    readers / writers / market builders / generator
functions  column functions (contract terms); list helpers live in
           operators.reshape and sources.text
operators  row and group operators (ranking, reshaping, filters, joins,
           aggregates, set operations, knapsack choice, verification)
plans      iterative matching plans (hospital-optimal, doctor-optimal,
           contracts) and their convergence reports

Modules
-------
jobs       command-line jobs: generate preference files; match, verify, write
catalog    registered queries on the driver tables (see __spark_entry__.py)
oracle     DuckDB SQL for those queries
"""

from duetto.names import DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK

__all__ = ["DOCTOR", "HOSPITAL", "DOCTOR_RANK", "HOSPITAL_RANK"]
