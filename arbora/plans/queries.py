"""All queries over the driver's tables, and their oracle SQL."""

from __future__ import annotations

from arbora.plans import q_files, q_groups, q_history, q_integrate, q_more, q_stats

QUERIES = {**q_history.QUERIES, **q_groups.QUERIES, **q_stats.QUERIES, **q_integrate.QUERIES, **q_more.QUERIES, **q_files.QUERIES}
SQL = {**q_history.SQL, **q_groups.SQL, **q_stats.SQL, **q_integrate.SQL, **q_more.SQL, **q_files.SQL}
