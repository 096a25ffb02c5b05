"""Every operator as a query over the driver tables, with the SQL that must give the same rows.

``part`` stands for players, ``orders`` for season facts, ``events`` for dated values, region, nation and customer for
league, club and player, ``lineitem`` for match statistics, ``embeddings`` for feature vectors.
"""

from __future__ import annotations

from touchline.plans.catalogue import files, matching, merging, models, parsing, reports, screens

_PARTS = (screens, parsing, merging, matching, models, reports, files)


def all_queries() -> dict:
    return {name: run for part in _PARTS for name, (run, _) in part.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
