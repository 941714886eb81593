"""The list of entities a landing run covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silvermill.sources.envelopes import Scope


def load_entities(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of ``{owner, repo}`` objects."""
    return spark.read.schema("owner string, repo string").option("multiLine", "true").json(path)


def scope_entities(entities: DataFrame, owner: str | None = None, repo: str | None = None) -> DataFrame:
    """All entities, or the exact (owner, repo); it is an error if that one is not listed."""
    scope = Scope(owner=owner, repo=repo)
    if scope.entity is None:
        return entities
    scoped = entities.filter(scope.entity)
    if scoped.isEmpty():
        raise ValueError(f"{owner}/{repo} is not in the entity list.")
    return scoped
