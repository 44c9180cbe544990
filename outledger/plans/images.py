"""Image stubs: the rows exist, their texts are blank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.plans.items import Tables
from outledger.rules import Rules
from outledger.sources.tables import extract


def image_rows(t: Tables, rules: Rules) -> DataFrame:
    """One stub per item of the image groups."""
    return extract(
        t["items"],
        F.rtrim("U_SubGrp7").isin(*[g.rstrip(" ") for g in rules.image_groups]),
        {
            "skuCode": F.col("ItemCode"),
            "ColorCode": F.col("U_SubGrp6"),
            "fileName": "",
            "Description": "",
            "base64Data": "",
        },
    )
