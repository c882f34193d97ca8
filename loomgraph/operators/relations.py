"""Which pairs of entity types may be related, and the entity types themselves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entity types, fixed values: tagged by models, and by tools.
MODEL_TYPES = ("disease", "chemical", "celltype", "go", "bodypart", "diagnosis", "treatment", "location", "food")
TOOL_TYPES = ("gene", "species", "mutation", "cellline")

#: Unordered pairs of types that may be related, fixed values.
ALLOWED = (
    ("disease", "treatment"), ("celltype", "go"), ("disease", "chemical"), ("gene", "chemical"), ("celltype", "mutation"),
    ("chemical", "treatment"), ("mutation", "go"), ("chemical", "mutation"), ("species", "mutation"), ("disease", "go"),
    ("gene", "go"), ("gene", "mutation"), ("disease", "mutation"), ("food", "disease"), ("disease", "bodypart"),
    ("disease", "location"), ("bodypart", "celltype"), ("gene", "disease"), ("celltype", "bodypart"), ("chemical", "celltype"),
    ("gene", "celltype"), ("disease", "celltype"), ("disease", "diagnose"), ("disease", "species"), ("gene", "species"),
    ("gene", "gene"),
)


def allowed(type_1: Column, type_2: Column, pairs: tuple = ALLOWED, aliases: dict[str, str] | None = None) -> Column:
    """Whether the unordered pair is listed. ``aliases`` renames types first (e.g. diagnosis to diagnose)."""
    for old, new in (aliases or {}).items():
        type_1, type_2 = (F.when(t == old, new).otherwise(t) for t in (type_1, type_2))
    keys = sorted({"_".join(sorted(p)) for p in pairs})
    return F.concat_ws("_", F.least(type_1, type_2), F.greatest(type_1, type_2)).isin(keys)
