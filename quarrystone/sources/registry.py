"""The source registry: a YAML document as one wide table."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.schemas import SOURCE

PRIORITIES = ("high", "medium", "low")
_FIELDS = [x.strip().split()[0] for x in SOURCE.split(", ")]


def load_config(path: str) -> dict:
    """A YAML mapping; anything else is an error."""
    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f)
    if not isinstance(found, dict):
        raise ValueError(f"{path} doesn't hold a mapping")
    return found


def registry(spark: SparkSession, config: dict, implemented: tuple[str, ...] = ()) -> DataFrame:
    """All sources of a configuration: repositories and sites by category, datasets by provider.

    A configuration is a hand-written file, so it is read on the driver. Priority defaults to medium,
    and an unknown one fails.
    """
    rows = []

    def add(kind: str, category: str | None, entry: dict, **more) -> None:
        priority = entry.get("priority", "medium")
        if priority not in PRIORITIES:
            raise ValueError(f"unknown priority {priority!r} of {entry.get('name')!r}")
        row = dict.fromkeys(_FIELDS) | {"name": entry.get("name"), "data_types": entry.get("data_types", []), "source_type": kind, "priority": priority, "enabled": entry.get("enabled", True), "category": category, "implemented": entry.get("name") in implemented if implemented else True} | more
        rows.append(tuple(row[f] for f in _FIELDS))

    for category, entries in (config.get("github_repos") or {}).items():
        for e in entries:
            add("github", category, e, url=e.get("url"), subdirs=e.get("subdirs", []))
    for category, entries in (config.get("web_scrapers") or {}).items():
        for e in entries:
            add("web", category, e, base_url=e.get("base_url"), url=e.get("base_url"), endpoints=e.get("endpoints", []), requires_js=e.get("requires_js", False), pagination=e.get("pagination", False))
    for provider, entries in (config.get("dataset_downloads") or {}).items():
        for e in entries or []:
            add(provider, None, e, dataset_id=e.get("dataset_id"), description=e.get("stats") or e.get("name") or e.get("dataset_id"))
    return spark.createDataFrame(rows, SOURCE)


def default_datasets(sources: DataFrame, provider: str, fallback: DataFrame) -> DataFrame:
    """(dataset_id, description) of a provider; ``fallback`` if it has none."""
    own = sources.filter((F.col("source_type") == provider) & F.col("dataset_id").isNotNull()).select("dataset_id", "description")
    some = own.agg(F.count("*").alias("n"))
    return own.union(fallback.select("dataset_id", "description").crossJoin(F.broadcast(some)).filter("n = 0").drop("n"))


def select_sources(sources: DataFrame, category: str | None = None, priority: str | None = None) -> DataFrame:
    """Filter by category and priority; None is all, an unknown category is nothing."""
    keep = F.lit(True)
    if category is not None:
        keep = keep & (F.col("category") == category)
    if priority is not None:
        keep = keep & (F.col("priority") == priority)
    return sources.filter(keep)


def categories(sources: DataFrame, position: str = "position") -> DataFrame:
    """Distinct categories in the order of first appearance."""
    return sources.groupBy("category").agg(F.min(position).alias("first")).orderBy("first").select("category")


def source_json(sources: DataFrame) -> DataFrame:
    """One JSON object a source, without the fields its type lacks."""
    return sources.select("name", "source_type", F.to_json(F.struct(*sources.columns)).alias("source"))


def invalid_categories(requested: DataFrame, known: DataFrame, column: str = "category") -> DataFrame:
    """Requested categories that don't exist; any row means that nothing may run."""
    return requested.select(column).distinct().join(known.select(column), column, "left_anti").orderBy(column)
