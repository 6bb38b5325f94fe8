"""All queries of the core package and their SQL."""

from __future__ import annotations

from freshet.plans import composites, problems, reference

QUERIES: dict = {**problems.QUERIES, **reference.QUERIES, **composites.QUERIES}
SQL: dict = {**problems.SQL, **reference.SQL, **composites.SQL}
FLAGSHIP = reference.episode_assembly
