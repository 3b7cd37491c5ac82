"""Ingest of the ten source tables from CSV exports, typed by the declared schemas.

Columns bind by position (the header line is skipped, its names ignored), exactly like a
database COPY into a pre-created table. Review exports are de-duplicated on load, the missing
category translations are patched, NULL categories are filled, and the geolocation table gets
its dense surrogate key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dedup import keep_latest
from ..operators.quality import surrogate_key
from .dimensions import fill_unknown, patch_rows
from .files import read_csv

# Translations missing from the original translation export, added on load.
MISSING_TRANSLATIONS = (
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_food_appliances"),
    ("pc_gamer", "gaming_computer"),
    ("unknown_category", "unknown_category"),
)


def load_roles(spark: SparkSession, paths: Mapping[str, str],
               translation_patch: Sequence[tuple] = MISSING_TRANSLATIONS) -> dict[str, DataFrame]:
    """``paths`` maps role name -> CSV path (``order_reviews`` may be the raw, duplicated export)."""
    out: dict[str, DataFrame] = {}
    for role, path in paths.items():
        if role == "order_reviews":
            raw = read_csv(spark, path, schemas.ORDER_REVIEWS_RAW)
            out[role] = keep_latest(raw, first_columns=("review_id",))
        elif role == "geolocation":
            geo = read_csv(spark, path, schemas.GEOLOCATION)
            out[role] = surrogate_key(geo, [F.col(c) for c in schemas.GEOLOCATION.fieldNames()],
                                      name=schemas.GEOLOCATION_KEY)
        else:
            out[role] = read_csv(spark, path, schemas.ROLE_SCHEMAS[role])
    if "category_translation" in out:
        out["category_translation"] = patch_rows(out["category_translation"], translation_patch, replace=True)
    if "products" in out:
        out["products"] = fill_unknown(out["products"])
    return out
